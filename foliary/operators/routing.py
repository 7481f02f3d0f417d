"""From ingest events to documents: format routing, conversion and the language gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions import documents as D
from foliary.functions import envelope as E
from foliary.functions import news as N
from foliary.functions import pulse as P
from foliary.functions.text import DETECTORS
from foliary.schemas import ANNOTATION
from foliary.session import land
from foliary.sources.codes import with_labels

UNRECOGNISED = "unrecognised format"
UNCONVERTIBLE = "conversion failed"
INGESTION = "ingestion"


def format_of(document: str) -> Column:
    """First format a document (variant column) fits: news, canonical, pulse; else null."""
    return (
        F.when(N.is_news(document), "news")
        .when(D.is_canonical(document), "canonical")
        .when(P.is_pulse(document), "pulse")
    )


def route_formats(parsed: DataFrame, processed_at: Column, labels=None) -> DataFrame:
    """Turn parsed envelopes into documents.

    Adds ``format``, ``doc`` (document struct, null on failure), ``error`` (null on success) and
    ``target_id`` (the id the document goes by). ``labels`` is a code label lookup or a code table of
    any size; without it all codes are unknown.
    """
    routed = parsed.withColumn("format", format_of("document")).withColumns({
        "_news": F.when(F.col("format") == "news", N.news_fields("document")),
        "_pulse": F.when(F.col("format") == "pulse", P.pulse_fields("document")),
        "_wire": F.when(F.col("format") == "canonical", D.canonical_fields("document")),
    })
    if isinstance(labels, DataFrame):
        routed, labels = with_labels(routed, "seq", N.code_keys(F.col("_news")), labels)
    facets = (
        N.code_facets(F.col("_news"), labels) if labels is not None
        else F.array().cast(f"array<{ANNOTATION}>")
    )
    routed = routed.withColumn(
        "error",
        F.when(F.col("format").isNull(), UNRECOGNISED)
        .when((F.col("format") == "news") & N.bad_dates(F.col("_news")), UNCONVERTIBLE)
        .when((F.col("format") == "pulse") & P.unconvertible(F.col("_pulse")), UNCONVERTIBLE),
    ).withColumn(
        "doc",
        F.when(F.col("error").isNotNull(), F.lit(None))
        .when(F.col("format") == "news", D.news_document(F.col("doc_id"), F.col("_news"), facets, processed_at))
        .when(F.col("format") == "pulse", D.pulse_document(F.col("doc_id"), F.col("_pulse"), processed_at))
        .when(F.col("format") == "canonical", D.document_from_wire(F.col("_wire"))),
    )
    return routed.withColumn(
        "target_id", F.coalesce("doc.document_id", "doc_id")
    ).drop("_news", "_pulse", "_wire", "_labels")


#: What detectors call English.
ENGLISH = ("eng", "en")


def gate_language(routed: DataFrame, detector: str | Callable[[Column], Column] = "always_english") -> DataFrame:
    """Add ``lang`` and turn documents in other languages than English into errors.

    ``detector`` is a name from ``DETECTORS`` or any function from the text's column to a language's.
    """
    detect = DETECTORS[detector] if isinstance(detector, str) else detector
    lang = F.when(F.col("doc").isNotNull(), detect(F.col("doc.extracted_text")))
    gated = routed.withColumn("lang", F.coalesce(lang, F.when(F.col("doc").isNotNull(), "und")))
    refused = ~F.col("lang").isin(*ENGLISH)
    return gated.withColumn(
        "error",
        F.when(refused, F.concat("lang", F.lit(" is not supported for: "), "target_id")).otherwise(F.col("error")),
    )


def read_events(
    events: DataFrame, processed_at: Column, labels=None,
    detector: str | Callable[[Column], Column] = "always_english",
) -> tuple[DataFrame, DataFrame]:
    """Events → (accepted, rejected).

    ``accepted``: seq, doc_id, target_id, format, lang, overrides, doc, error, raw (the document as
    it came, kept for errors), materialised so that the JSON is read once. ``rejected``: events whose envelope could not be read; they are
    logged apart and are no dead letters.
    """
    parsed = E.parse_envelopes(events).withColumn(
        "overrides", F.when(F.col("parsed"), E.overrides_of(F.col("metadata")))
    )
    gated = gate_language(route_formats(parsed, processed_at, labels), detector)
    # Materialise before splitting: a filter on ``parsed`` would be pushed down and parse again.
    done = land(gated.select(
        "seq", "doc_id", "target_id", "format", "lang", "overrides", "doc", "error", "parsed",
        F.when(~F.col("parsed"), F.col("value")).when(F.col("error").isNotNull(), F.to_json("document")).alias("raw"),
    ))
    rejected = done.where(~F.col("parsed")).select("seq", "doc_id", F.col("raw").alias("value"))
    return done.where("parsed").drop("parsed"), rejected
