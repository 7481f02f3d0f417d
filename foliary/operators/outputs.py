"""Notices, dead letters and status rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions.documents import document_to_json, thin_document
from foliary.functions.once import once
from foliary.operators.tables import tenants_by_document
from foliary.schemas import DUPLICATE_RESPONSE

CORE, ANNOTATOR = "CORE", "ANNOTATOR"
SUCCESS, FAILURE = "SUCCESS", "FAILURE"
PROCESSING_ERROR = "Document Processing Error"


# --- ontologies -----------------------------------------------------------------------------

def latest_ontologies(ontologies: DataFrame) -> DataFrame:
    """``(tenant, id)`` of each tenant's newest ontology."""
    return ontologies.groupBy("tenant").agg(F.max_by("id", "version").alias("id"))


def ontology_mappings(doc_ids: DataFrame, tenant_docs: DataFrame, ontologies: DataFrame) -> DataFrame:
    """``(doc_id, ontologies)``: the (tenant, id) pairs of a document's tenants that have an ontology."""
    wanted = tenant_docs.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
    found = wanted.join(latest_ontologies(ontologies), "tenant").groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.struct("tenant", "id"))).alias("ontologies")
    )
    nothing = F.array().cast("array<struct<tenant:string,id:string>>")
    return doc_ids.join(found, "doc_id", "left").withColumn("ontologies", F.coalesce("ontologies", nothing))


# --- notices --------------------------------------------------------------------------------

def thin_view(documents: DataFrame) -> DataFrame:
    """``(doc_id, doc)`` with the document in the form it is announced in."""
    return documents.withColumn("doc", thin_document(F.col("doc")))


def update_notices(documents: DataFrame, tenant_docs: DataFrame, ontologies: DataFrame) -> DataFrame:
    """``(key, value)`` messages announcing stored documents ``(doc_id, doc)``."""
    mapped = ontology_mappings(documents, tenant_docs, ontologies)
    body = F.struct(thin_document(F.col("doc")).alias("document"), "ontologies")
    return mapped.select(F.col("doc_id").alias("key"), F.to_json(body).alias("value"))


def with_lists(events: DataFrame, lists: DataFrame | None) -> DataFrame:
    """``events`` with ``duplicates``: the whole list by ``seq`` (:meth:`neardup.CopyLists.lists`), else the earliest copy."""
    earliest = F.when(F.col("duplicate_of").isNotNull(), F.array("duplicate_of"))
    if lists is None:
        return events.withColumn("duplicates", earliest)
    given = lists.select("seq", "duplicates")
    copied = events.where("outcome = 'DUPLICATE'").join(given, "seq", "left")
    others = events.where("outcome <> 'DUPLICATE'").withColumn("duplicates", F.lit(None).cast("array<string>"))
    return copied.withColumn("duplicates", F.coalesce("duplicates", earliest)).unionByName(others)


def duplicate_notices(events: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """``(key, value)`` messages, one per DUPLICATE event, naming its earlier copies.

    Without ``lists`` a notice names the earliest copy, the one its overrides went to: a full list is as long
    as the group, and a batch need not send it with every message.
    """
    body = F.struct(F.col("target_id").alias("doc_id"), F.col("duplicates").alias("duplicated_docs"))
    return with_lists(events, lists).where("outcome = 'DUPLICATE'").select(
        F.col("target_id").alias("key"), F.to_json(body).alias("value")
    )


def duplicate_response_json(hits: Column) -> Column:
    """JSON of a list of (doc_id, score) hits; an empty list gives ``{}``."""
    empty = F.coalesce(F.size(hits), F.lit(0)) == 0
    return F.when(empty, "{}").otherwise(F.to_json(F.struct(hits.alias("duplicated_docs"))))


def duplicate_response_from_json(text: Column) -> Column:
    """Hits of a duplicate response; null for text that is no JSON object."""
    nothing = F.array().cast("array<struct<doc_id:string,score:decimal(3,2)>>")
    return once(F.try_parse_json(text), lambda given: F.when(
        F.call_function("schema_of_variant", given).startswith("OBJECT"),
        F.coalesce(F.try_variant_get(given, "$", DUPLICATE_RESPONSE).getField("duplicated_docs"), nothing),
    ))


# --- errors and status ------------------------------------------------------------------------

def error_rows(events: DataFrame) -> DataFrame:
    """``(seq, doc_id, operation, error_msg, stacktrace)`` of all events that carry an error.

    That is failed events, and duplicates whose original is not stored. An error names the document's own
    id; where none could be read from the event, that is the event's key.
    """
    return events.where("message is not null").select(
        "seq", F.col("target_id").alias("doc_id"),
        "operation", F.col("message").alias("error_msg"),
        F.concat_ws(": ", "operation", "message").alias("stacktrace"),
    )


def dead_letters(events: DataFrame, at_ms: Column) -> DataFrame:
    return error_rows(events).drop("seq").withColumn("timestamp", at_ms.cast("bigint"))


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    return letters.select(F.col("doc_id").alias("key"), F.to_json(F.struct(*letters.columns)).alias("value"))


def _status(rows: DataFrame, at_ms: Column, scope: str) -> DataFrame:
    return rows.select(
        "doc_id", "stage", "processor_type", "status", F.lit(scope).alias("scope"),
        at_ms.cast("bigint").alias("start_ms"), at_ms.cast("bigint").alias("end_ms"), "message",
    )


def _entry(doc_id: str, stage: str, status: str, message: Column) -> Column:
    return F.struct(
        F.col(doc_id).alias("doc_id"), F.lit(stage).alias("stage"), F.lit(CORE).alias("processor_type"),
        F.lit(status).alias("status"), message.alias("message"),
    )


def duplicate_status_message(doc_id: Column, duplicates: Column) -> Column:
    """Message of a duplicate's failure row; the ids follow each other without a separator."""
    return F.concat(doc_id, F.lit(" duplicates: "), F.array_join(duplicates, ""))


def core_status(events: DataFrame, at_ms: Column, scope: str = "corpus", lists: DataFrame | None = None) -> DataFrame:
    """Status rows of a batch's ingestion and core processing, several per event where due.

    A duplicate's row names its earliest copy, or with ``lists`` all of them, see :func:`with_lists`.
    """
    blank = F.lit("")
    done = F.array(
        _entry("target_id", "ingestion", SUCCESS, blank), _entry("target_id", "core-processing", SUCCESS, blank)
    )
    copied = F.array(_entry(
        "target_id", "ingestion", FAILURE,
        duplicate_status_message(F.col("target_id"), F.col("duplicates")),
    ))
    original = F.array(
        _entry("duplicate_of", "ingestion", SUCCESS, blank), _entry("duplicate_of", "core-processing", SUCCESS, blank)
    )
    failed = F.array(_entry(
        "target_id", PROCESSING_ERROR, FAILURE, F.concat_ws(": ", "operation", "message")
    ))
    rows = (
        F.when(F.col("outcome").isin("NEW", "UPDATE"), done)
        .when((F.col("outcome") == "DUPLICATE") & (F.col("target_change") == "UPDATE"), F.concat(copied, original))
        .when((F.col("outcome") == "DUPLICATE") & F.col("message").isNotNull(), F.concat(copied, failed))
        .when(F.col("outcome") == "DUPLICATE", copied)
        .when(F.col("outcome") == "ERROR", failed)
    )
    return _status(with_lists(events, lists).select(F.inline(rows)), at_ms, scope)


def annotator_status(results: DataFrame, at_ms: Column, scope: str = "corpus") -> DataFrame:
    """Status row per (document, annotator): SUCCESS with or without a result, else FAILURE."""
    ok = F.col("status") != "failed"
    return _status(results.select(
        "doc_id", F.col("label").alias("stage"), F.lit(ANNOTATOR).alias("processor_type"),
        F.when(ok, SUCCESS).otherwise(FAILURE).alias("status"),
        F.when(ok, "").alias("message"),
    ), at_ms, scope)


def write_status(rows: DataFrame, url: str, table: str = "pipeline_status", properties: dict | None = None) -> None:
    """Append status rows to a JDBC table (the driver jar is the caller's)."""
    rows.write.jdbc(url, table, mode="append", properties=properties or {})


def cdr_json(documents: DataFrame) -> DataFrame:
    """``(doc_id, doc)`` → ``(doc_id, json)``."""
    return documents.select("doc_id", document_to_json(F.col("doc")).alias("json"))


def search_rows(documents: DataFrame, tenant_docs: DataFrame) -> DataFrame:
    """Rows of the search view: the document's fields and its tenants."""
    wanted = tenant_docs.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    return documents.select("doc_id", "doc.*").join(tenants_by_document(wanted), "doc_id", "left").drop("doc_id")
