"""Explicit schemas of every record the library reads or writes (Spark DDL)."""

EVENT = "seq BIGINT, doc_id STRING, value STRING"

ENVELOPE_METADATA = (
    "STRUCT<tenants: ARRAY<STRING>, source_uri: STRING, labels: ARRAY<STRING>, "
    "genre: STRING, ingestion_system: STRING, reannotate: BOOLEAN>"
)

OFFSET_TAG = (
    "STRUCT<offset_start: INT, offset_end: INT, value: STRING, tag: STRING, score: DOUBLE>"
)
FACET = "STRUCT<value: STRING, score: DOUBLE>"
GENEALOGY = (
    "STRUCT<similar_documents: MAP<STRING, DOUBLE>, similarity_matrix: ARRAY<ARRAY<DOUBLE>>>"
)

# One content column per annotation type; exactly one of them is set.
ANNOTATION = (
    "STRUCT<type: STRING, label: STRING, version: STRING, class: STRING, "
    f"text: STRING, dictionary: MAP<STRING, STRING>, tags: ARRAY<{OFFSET_TAG}>, "
    f"facets: ARRAY<{FACET}>, genealogy: {GENEALOGY}, translation: STRING>"
)

METADATA_FIELDS = {
    "creation_date": "DATE",
    "modification_date": "DATE",
    "author": "STRING",
    "doc_type": "STRING",
    "description": "STRING",
    "original_language": "STRING",
    "classification": "STRING",
    "title": "STRING",
    "publisher": "STRING",
    "url": "STRING",
    "pages": "INT",
    "subject": "STRING",
    "creator": "STRING",
    "producer": "STRING",
    "stated_genre": "STRING",
    "predicted_genre": "STRING",
}


def _struct(fields: dict[str, str]) -> str:
    return "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in fields.items()) + ">"


METADATA = _struct(METADATA_FIELDS)

DOCUMENT_FIELDS = {
    "document_id": "STRING",
    "capture_source": "STRING",
    "content_type": "STRING",
    "extracted_text": "STRING",
    "uri": "STRING",
    "source_uri": "STRING",
    "extracted_ntriples": "STRING",
    "timestamp": "TIMESTAMP",
    "extracted_numeric": "MAP<STRING, STRING>",
    "labels": "ARRAY<STRING>",
    "extracted_metadata": METADATA,
    "annotations": f"ARRAY<{ANNOTATION}>",
}
DOCUMENT = _struct(DOCUMENT_FIELDS)

# The same fields as top-level columns: the row type of the corpus table.
CORPUS = ", ".join(f"{name} {kind}" for name, kind in DOCUMENT_FIELDS.items())

TENANT_DOCS = "tenant STRING, doc_id STRING"
ONTOLOGIES = "tenant STRING, id STRING, version INT"
CODES = "kind STRING, code STRING, label STRING"

STATUS = (
    "doc_id STRING, stage STRING, processor_type STRING, status STRING, scope STRING, "
    "start_ms BIGINT, end_ms BIGINT, message STRING"
)
DEAD_LETTER = (
    "doc_id STRING, operation STRING, error_msg STRING, stacktrace STRING, timestamp BIGINT"
)
DUPLICATE_RESPONSE = "STRUCT<duplicated_docs: ARRAY<STRUCT<doc_id: STRING, score: DECIMAL(3,2)>>>"

# Canonical JSON, as it travels: metadata keys are spelt as in the wire format, annotation
# content stays open until its type is known.
CANONICAL_METADATA_KEYS = {
    "creation_date": "CreationDate",
    "modification_date": "ModificationDate",
    "author": "Author",
    "doc_type": "Type",
    "description": "Description",
    "original_language": "OriginalLanguage",
    "classification": "Classification",
    "title": "Title",
    "publisher": "Publisher",
    "url": "URL",
    "pages": "Pages",
    "subject": "Subject",
    "creator": "Creator",
    "producer": "Producer",
    "stated_genre": "StatedGenre",
    "predicted_genre": "PredictedGenre",
}
CANONICAL_JSON = _struct({
    **DOCUMENT_FIELDS,
    "extracted_metadata": _struct({
        key: METADATA_FIELDS[column] for column, key in CANONICAL_METADATA_KEYS.items()
    }),
    "annotations": (
        "ARRAY<STRUCT<type: STRING, label: STRING, version: STRING, class: STRING, content: VARIANT>>"
    ),
})
