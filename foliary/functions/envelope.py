"""Ingest envelopes: ``{"metadata": {...}?, "document": {...}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.schemas import ENVELOPE_METADATA

DEFAULT_GENRE = "unspecified"


def _kind(variant: str) -> Column:
    return F.expr(f"schema_of_variant({variant})")


def parse_envelopes(events: DataFrame) -> DataFrame:
    """Add ``metadata`` (struct or null), ``document`` (variant) and ``parsed`` (boolean).

    The JSON text is read once; everything later works on the variant. Unknown keys are ignored.
    An envelope is unparsed when it is not a JSON object, when its document is not an object, or
    when its metadata does not fit the expected types.
    """
    read = events.withColumn("_envelope", F.try_parse_json("value"))
    read = read.withColumns({
        "document": F.expr("try_variant_get(_envelope, '$.document', 'variant')"),
        "_metadata": F.expr("try_variant_get(_envelope, '$.metadata', 'variant')"),
    })
    read = read.withColumn(
        "metadata", F.expr(f"try_variant_get(_metadata, '$', '{ENVELOPE_METADATA}')")
    )

    def wrong(field: str) -> Column:
        given = F.coalesce(_kind(f"try_variant_get(_metadata, '$.{field}', 'variant')"), F.lit("VOID"))
        return F.col(f"metadata.{field}").isNull() & (given != "VOID")

    no_metadata = F.coalesce(_kind("_metadata"), F.lit("VOID")) == "VOID"
    mistyped = wrong("tenants")
    for field in ("labels", "source_uri", "genre", "ingestion_system", "reannotate"):
        mistyped = mistyped | wrong(field)
    fits = no_metadata | (_kind("_metadata").startswith("OBJECT") & ~mistyped)
    return read.withColumn(
        "parsed", F.coalesce(_kind("document").startswith("OBJECT") & fits, F.lit(False))
    ).drop("_envelope", "_metadata")


def overrides_of(metadata: Column) -> Column:
    """Overrides an envelope asks for, with the defaults of a missing or partial metadata block."""
    def names(field: str) -> Column:
        given = F.array_distinct(F.array_compact(metadata.getField(field)))
        return F.coalesce(given, F.array().cast("array<string>"))

    genre = metadata.getField("genre")
    return F.struct(
        names("labels").alias("labels"),
        metadata.getField("source_uri").alias("source_uri"),
        names("tenants").alias("tenants"),
        F.when(F.length(genre) > 0, genre).otherwise(DEFAULT_GENRE).alias("genre"),
        F.coalesce(metadata.getField("reannotate"), F.lit(False)).alias("run_annotators"),
    )


def metadata_to_json(metadata: Column) -> Column:
    """Metadata block as JSON; every key is written, absent values as null."""
    return F.to_json(metadata, {"ignoreNullFields": "false"})


def metadata_from_json(text: Column) -> Column:
    """Metadata block from JSON text; null when the text is no such object."""
    return F.from_json(text, ENVELOPE_METADATA)


def envelope_to_json(metadata: Column, document: Column) -> Column:
    """Whole envelope as JSON; the document (a variant) is written as it came."""
    return F.to_json(F.struct(metadata.alias("metadata"), document.alias("document")))
