"""Lookups in, and updates of, the corpus, tenant and search tables. All are pure functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foliary.schemas import ANNOTATION

#: Fields of a stored document that may change after its first batch.
CHANGING = ("labels", "source_uri", "extracted_metadata", "annotations", "tenants")


def _empty_names() -> Column:
    return F.array().cast("array<string>")


# --- lookups ------------------------------------------------------------------------------------

def find_documents(ids: DataFrame, corpus: DataFrame) -> DataFrame:
    """Stored document for every asked ``doc_id``; ``doc`` is null for those not stored."""
    stored = corpus.select(F.col("document_id").alias("doc_id"), F.struct(*corpus.columns).alias("doc"))
    return ids.join(stored, "doc_id", "left")


def documents_exist(ids: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(doc_id, stored)`` for every asked id."""
    known = corpus.select(F.col("document_id").alias("doc_id")).withColumn("_stored", F.lit(True))
    return ids.join(known, "doc_id", "left").select("doc_id", F.coalesce("_stored", F.lit(False)).alias("stored"))


def tenants_by_document(tenant_docs: DataFrame) -> DataFrame:
    """``(doc_id, tenants)``, tenants distinct and sorted."""
    return tenant_docs.groupBy("doc_id").agg(F.array_sort(F.collect_set("tenant")).alias("tenants"))


def find_existing(incoming: DataFrame, corpus: DataFrame, tenant_docs: DataFrame) -> DataFrame:
    """Every incoming ``doc_id`` with the stored document (or null) and its current tenants."""
    asked = incoming.select("doc_id").distinct()
    memberships = tenants_by_document(tenant_docs.join(asked, "doc_id", "left_semi"))
    return (
        find_documents(incoming, corpus).join(memberships, "doc_id", "left")
        .withColumn("tenants", F.coalesce("tenants", _empty_names()))
    )


# --- corpus ---------------------------------------------------------------------------------

def upsert(table: DataFrame, changes: DataFrame, key: str = "document_id", order: str = "seq") -> DataFrame:
    """Table after the changes: the last change of a key (by ``order``) replaces or adds its row.

    Only the changes are ranked; the untouched part of the table is passed through an anti join.
    """
    newest = W.partitionBy(key).orderBy(F.col(order).desc())
    last = changes.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", order)
    return table.join(last.select(key), key, "left_anti").unionByName(last)


def append_annotations(corpus: DataFrame, additions: DataFrame, replace: bool = False) -> DataFrame:
    """Append ``(doc_id, seq, annotation)`` rows to the documents' annotations in ``seq`` order.

    With ``replace`` an addition takes the place of stored annotations with its label.
    """
    added = additions.groupBy("doc_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seq", "annotation")), _by_seq), lambda e: e["annotation"]
        ).alias("_added")
    )
    nothing = F.array().cast(f"array<{ANNOTATION}>")
    added_or_none = F.coalesce(F.col("_added"), nothing)
    stored = F.coalesce(F.col("annotations"), nothing)
    if replace:
        labels = F.transform(added_or_none, lambda a: a["label"])
        stored = F.filter(stored, lambda a: ~F.array_contains(labels, a["label"]))
    return (
        corpus.join(added.withColumnRenamed("doc_id", "document_id"), "document_id", "left")
        .withColumn("annotations", F.concat(stored, added_or_none))
        .select(*corpus.columns)
    )


def _by_seq(a: Column, b: Column) -> Column:
    return F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0)


def add_to_tenants(tenant_docs: DataFrame, additions: DataFrame) -> DataFrame:
    """Memberships after adding some; adding one twice changes nothing."""
    fresh = additions.select("tenant", "doc_id").distinct().join(tenant_docs, ["tenant", "doc_id"], "left_anti")
    return tenant_docs.unionByName(fresh)


# --- search view ----------------------------------------------------------------------------

def search_upsert(view: DataFrame, documents: DataFrame) -> DataFrame:
    """Partial upsert: fields a document sets replace those of the view, null ones stay."""
    fields = [c for c in view.columns if c != "document_id"]
    new = documents.select("document_id", *[F.col(c).alias(f"_new_{c}") for c in documents.columns if c != "document_id"])
    return view.join(new, "document_id", "full_outer").select(
        "document_id",
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in documents.columns else F.col(c)
            for c in fields
        ],
    )


def merge_parts(parts: DataFrame, order: str) -> DataFrame:
    """Documents from parts ``(document_id, …)``: of every field the value that the newest part by ``order`` sets.

    A part leaves a field alone by a null; an empty list is a value. Of one document no two parts may have equal
    ``order``.
    """
    fields = [c for c in parts.columns if c not in ("document_id", order)]
    merged = parts.groupBy("document_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields])
    return merged.select(*[c for c in parts.columns if c != order])


def search_part(documents: DataFrame, whole: Column) -> DataFrame:
    """Rows of the search view as parts: all fields where ``whole``, else those that updates and annotators change."""
    kept = ("document_id", *CHANGING)
    return documents.select(*[
        F.col(c) if c in kept else F.when(whole, F.col(c)).alias(c) for c in documents.columns
    ])


def search_add_annotations(view: DataFrame, additions: DataFrame) -> DataFrame:
    """Append annotations in the view; a document without any gets a new list."""
    return append_annotations(view, additions)


def search_set_tenants(view: DataFrame, tenants: DataFrame) -> DataFrame:
    """Replace a document's tenants by the full new set ``(doc_id, tenants)``."""
    new = tenants.select(F.col("doc_id").alias("document_id"), F.col("tenants").alias("_tenants"))
    return (
        view.join(new, "document_id", "left")
        .withColumn("tenants", F.coalesce("_tenants", "tenants")).select(*view.columns)
    )


def search_get(view: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents of the view with the asked ids (``doc_id``)."""
    return view.join(ids.select(F.col("doc_id").alias("document_id")).distinct(), "document_id", "left_semi")
