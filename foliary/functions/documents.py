"""Columns that build, convert and project the canonical document record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.functions import news as N
from foliary.functions import pulse as P
from foliary.functions.once import once
from foliary.schemas import (
    ANNOTATION,
    CANONICAL_JSON,
    CANONICAL_METADATA_KEYS,
    DOCUMENT,
    DOCUMENT_FIELDS,
    FACET,
    GENEALOGY,
    METADATA,
    METADATA_FIELDS,
    OFFSET_TAG,
)


def _record(schema: str, fields: dict[str, Column], names: Iterable[str]) -> Column:
    return F.struct(*[
        fields.get(name, F.lit(None)).alias(name) for name in names
    ]).cast(schema)


def document_record(metadata: dict[str, Column], **fields: Column) -> Column:
    """A whole document struct from the given fields; all others are null or empty."""
    filled = {
        "labels": F.array().cast("array<string>"),
        "annotations": F.array().cast(f"array<{ANNOTATION}>"),
        "extracted_numeric": F.create_map().cast("map<string,string>"),
        **fields,
        "extracted_metadata": _record(METADATA, metadata, METADATA_FIELDS),
    }
    return _record(DOCUMENT, filled, DOCUMENT_FIELDS)


def news_document(doc_id: Column, news: Column, annotations: Column, processed_at: Column) -> Column:
    get = news.getField
    empty = F.lit("")
    return document_record(
        {
            "creation_date": N.creation_date(get("publication_date"), get("publication_datetime")),
            "modification_date": N.epoch_date(get("modification_datetime")),
            "author": N.author(get("byline")),
            "doc_type": get("document_type"),
            "description": get("snippet"),
            "original_language": get("language_code"),
            "classification": F.lit(N.CLASSIFICATION),
            "title": get("title"),
            "publisher": get("publisher_name"),
            "url": empty,
            "subject": empty,
            "creator": empty,
            "producer": F.lit(N.PRODUCER),
        },
        document_id=doc_id,
        capture_source=F.lit(N.CAPTURE_SOURCE),
        content_type=F.lit(N.CONTENT_TYPE),
        extracted_text=N.article_text(get("snippet"), get("body")),
        source_uri=get("an"),
        timestamp=processed_at,
        annotations=annotations,
    )


def pulse_document(doc_id: Column, pulse: Column, processed_at: Column) -> Column:
    norm = pulse.getField("norm")
    kind = pulse.getField("norm_attribs").getField("type")
    empty = F.lit("")
    return document_record(
        {
            "creation_date": P.local_date(norm.getField("timestamp")),
            "author": empty,
            "doc_type": kind,
            "description": empty,
            "original_language": F.lit(P.LANGUAGE),
            "classification": F.lit(P.CLASSIFICATION),
            "title": P.title(pulse),
            "publisher": norm.getField("author"),
            "url": norm.getField("url"),
            "subject": empty,
            "creator": empty,
            "producer": F.lit(P.PRODUCER),
        },
        document_id=doc_id,
        capture_source=F.concat(F.lit(P.CAPTURE_PREFIX), F.coalesce(kind, F.lit("null"))),
        content_type=kind,
        extracted_text=norm.getField("body"),
        source_uri=F.coalesce(norm.getField("url"), empty),
        timestamp=processed_at,
    )


# --- canonical JSON ---------------------------------------------------------------------------

def is_canonical(document: str) -> Column:
    """An object whose ``document_id`` is a string."""
    return F.coalesce(
        F.expr(f"schema_of_variant(try_variant_get({document}, '$.document_id', 'variant'))") == "STRING",
        F.lit(False),
    )


def annotation_from_wire(wire: Column) -> Column:
    """Annotation with open content (variant) → typed annotation."""
    content, kind = wire.getField("content"), wire.getField("type")

    def when(name: str, schema: str) -> Column:
        return F.when(kind == name, F.try_variant_get(content, "$", schema)).alias(name)

    return F.struct(
        kind.alias("type"),
        wire.getField("label").alias("label"),
        wire.getField("version").alias("version"),
        wire.getField("class").alias("class"),
        when("text", "string"),
        when("dictionary", "map<string,string>"),
        when("tags", f"array<{OFFSET_TAG}>"),
        when("facets", f"array<{FACET}>"),
        when("genealogy", GENEALOGY),
        F.when(kind == "translation", F.to_json(content)).alias("translation"),
    ).cast(ANNOTATION)


def document_from_wire(wire: Column) -> Column:
    """Parsed canonical JSON (see ``CANONICAL_JSON``) → document struct."""
    meta = wire.getField("extracted_metadata")
    plain = {
        name: wire.getField(name) for name in DOCUMENT_FIELDS
        if name not in ("extracted_metadata", "annotations", "labels")
    }
    return document_record(
        {column: meta.getField(key) for column, key in CANONICAL_METADATA_KEYS.items()},
        **plain,
        labels=F.coalesce(F.array_distinct(wire.getField("labels")), F.array().cast("array<string>")),
        annotations=F.coalesce(
            F.transform(wire.getField("annotations"), annotation_from_wire),
            F.array().cast(f"array<{ANNOTATION}>"),
        ),
    )


def canonical_fields(document: str) -> Column:
    return F.expr(f"try_variant_get({document}, '$', '{CANONICAL_JSON}')")


def annotation_content_json(annotation: Column) -> Column:
    """The one content of an annotation as JSON text (a bare string for text annotations)."""
    get = annotation.getField
    return F.coalesce(
        get("text"),
        F.to_json(get("dictionary")),
        F.to_json(get("tags")),
        F.to_json(get("facets")),
        F.to_json(get("genealogy")),
        get("translation"),
    )


def annotation_to_wire(annotation: Column) -> Column:
    get = annotation.getField
    text = F.when(get("text").isNotNull(), F.to_json(F.array(get("text"))))
    quoted = F.substring(text, F.lit(2), F.length(text) - 2)
    content = F.coalesce(quoted, annotation_content_json(annotation))
    return F.struct(
        get("type").alias("type"),
        get("label").alias("label"),
        get("version").alias("version"),
        F.try_parse_json(content).alias("content"),
        get("class").alias("class"),
    )


def annotation_to_json(annotation: Column) -> Column:
    return F.to_json(annotation_to_wire(annotation))


def annotation_from_json(text: Column) -> Column:
    """Annotation from JSON text; null when the text is no annotation object."""
    wire = F.try_variant_get(
        F.try_parse_json(text), "$",
        "struct<type string, label string, version string, class string, content variant>",
    )
    return once(wire, lambda w: F.when(w.getField("type").isNotNull(), annotation_from_wire(w)))


def document_to_json(document: Column) -> Column:
    """Canonical JSON of a document; absent values are left out."""
    meta = document.getField("extracted_metadata")
    wire = [
        F.struct(*[
            meta.getField(column).alias(key) for column, key in CANONICAL_METADATA_KEYS.items()
        ]).alias(name) if name == "extracted_metadata"
        else F.transform(document.getField(name), annotation_to_wire).alias(name) if name == "annotations"
        else document.getField(name).alias(name)
        for name in DOCUMENT_FIELDS
    ]
    return F.to_json(F.struct(*wire), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"})


def document_from_json(text: Column) -> Column:
    """Document from canonical JSON; null unless it is an object with a string ``document_id``."""
    wire = F.try_variant_get(F.try_parse_json(text), "$", CANONICAL_JSON)
    return once(wire, lambda w: F.when(w.getField("document_id").isNotNull(), document_from_wire(w)))


# --- projections and predicates on documents and annotations ------------------------------------

def thin_document(document: Column) -> Column:
    """Document as announced: every field, annotations reduced to content and label."""
    thin = F.transform(
        document.getField("annotations"),
        lambda a: F.struct(annotation_content_json(a).alias("content"), a.getField("label").alias("label")),
    )
    return document.withField("annotations", thin)


def only_static(annotations: Column) -> Column:
    """Annotations that survive a new annotation run."""
    return F.filter(annotations, lambda a: F.coalesce(a.getField("class") == "static", F.lit(False)))


def has_content(annotation: Column) -> Column:
    """False when the content of the annotation is missing or empty."""
    get = annotation.getField
    return F.coalesce(
        (F.length(get("text")) > 0)
        | (F.size(get("dictionary")) > 0)
        | (F.size(get("tags")) > 0)
        | (F.size(get("facets")) > 0)
        | get("genealogy").isNotNull()
        | (F.length(get("translation")) > 0),
        F.lit(False),
    )


def relabel(annotation: Column, label: Column) -> Column:
    return annotation.withField("label", label)


ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def _utf16_text(text: Column) -> Column:
    """A text made ready for UTF-16 offsets. Only texts with characters outside the basic plane
    need their encoded form; in all others offsets count characters."""
    wide = F.when(text.rlike(ASTRAL), F.encode(text, "UTF-16BE"))
    return F.struct(
        text.alias("text"), wide.alias("wide"),
        F.coalesce((F.length(wide) / 2).cast("int"), F.length(text)).alias("units"),
    )


def _utf16_slice(ready: Column, start: Column, end: Column) -> Column:
    """Text between two offsets; null when they do not fit the text."""
    fits = (start >= 0) & (start <= end) & (end <= ready["units"])
    wide = F.decode(F.substring(ready["wide"], 2 * start + 1, 2 * (end - start)), "UTF-16BE")
    plain = F.substring(ready["text"], start + 1, end - start)
    return F.when(fits, F.when(ready["wide"].isNull(), plain).otherwise(wide))


def fill_tag_values(tags: Column, text: Column) -> Column:
    """Every tag with the stretch of text it covers as its value."""
    return once(_utf16_text(text), lambda ready: F.transform(
        tags, lambda t: t.withField("value", _utf16_slice(ready, t["offset_start"], t["offset_end"]))
    ))


def tags_fit(tags: Column, text: Column) -> Column:
    """True when all offsets lie inside the text."""
    return once(_utf16_text(text), lambda ready: F.forall(
        tags, lambda t: _utf16_slice(ready, t["offset_start"], t["offset_end"]).isNotNull()
    ))


# --- overrides ----------------------------------------------------------------------------------

def merge_overrides(document: Column, overrides: Column) -> Column:
    """Document with an envelope's overrides: labels added, source URI replaced if given, genre always."""
    stored = F.coalesce(document.getField("labels"), F.array().cast("array<string>"))
    return (
        document
        .withField("labels", F.array_union(stored, overrides.getField("labels")))
        .withField("source_uri", F.coalesce(overrides.getField("source_uri"), document.getField("source_uri")))
        .withField("extracted_metadata.stated_genre", overrides.getField("genre"))
    )


def tenant_delta(current: Column, wanted: Column) -> Column:
    """All tenants when at least one is new, else none."""
    nothing = F.array().cast("array<string>")
    return F.when(F.size(F.array_except(wanted, current)) > 0, F.array_union(current, wanted)).otherwise(nothing)


def needs_reannotation(before: Column, after: Column) -> Column:
    """True when text, title or description differ."""
    def same(field: str) -> Column:
        left, right = before, after
        for part in field.split("."):
            left, right = left.getField(part), right.getField(part)
        return left.eqNullSafe(right)

    return ~(same("extracted_text") & same("extracted_metadata.title") & same("extracted_metadata.description"))
