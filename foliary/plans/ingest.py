"""The decision about every ingest event: NEW, UPDATE, NOOP, DUPLICATE or ERROR.

Rules, in arrival order (``seq``):

* an event of a stored document only carries overrides; its content is ignored;
* a document not stored is compared with every text checked before it, rejected copies included,
  and its own text joins the checked ones; without a match it is NEW;
* a DUPLICATE is not stored; its overrides go to its earliest match, if that one is stored;
* overrides that change nothing are a NOOP.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions.documents import merge_overrides
from foliary.operators.fold import change_log
from foliary.operators.neardup import (
    NearDupSettings,
    class_tokens,
    earliest_hits,
    named_sets,
    shingle_sets,
    text_classes,
    two_earliest,
)
from foliary.operators.probe import FrameIndex, Index, probe
from foliary.operators.routing import INGESTION
from foliary.operators.tables import tenants_by_document
from foliary.session import among, cut, land, outside

DEDUPLICATION = "deduplication"
NO_TEXT = "deduplication failed - no text"
ORIGINAL_NOT_STORED = "original not stored"

class Lookup(Protocol):
    """Stored documents by id, for tables too large to be read (see :class:`foliary.sources.store.StoredCorpus`)."""

    def known(self, ids: DataFrame) -> DataFrame:
        """``(document_id, …)`` of those ``ids`` (document_id) that are stored."""

    def __call__(self, ids: DataFrame) -> DataFrame:
        """Rows of the stored documents among ``ids``, in the corpus schema."""


Corpus = DataFrame | Lookup


def stored_documents(corpus: Corpus, ids: DataFrame) -> DataFrame:
    """Rows of the corpus whose ``document_id`` is the first column of ``ids``."""
    asked = ids.toDF("document_id").distinct()
    return among(corpus, asked, "document_id") if isinstance(corpus, DataFrame) else corpus(asked)


def stored_ids_of(corpus: Corpus, ids: DataFrame) -> DataFrame:
    """``(document_id)`` of the first column of ``ids`` that are stored, without reading documents."""
    asked = ids.toDF("document_id").distinct()
    found = corpus.join(asked, "document_id", "left_semi") if isinstance(corpus, DataFrame) else corpus.known(asked)
    return found.select("document_id")


@dataclass(frozen=True)
class IngestSettings:
    """``dedup=None`` switches duplicate detection off; ``detector`` is a name or any function of the text's column."""

    detector: str | Callable[[Column], Column] = "always_english"
    dedup: NearDupSettings | None = field(default_factory=NearDupSettings)


@dataclass(frozen=True)
class Checked:
    """``first_new``: (doc_id, new_seq). ``hits``: (seq, hit_id) per event with text; hit_id is null
    for one without a match. ``index_rows``: shingle sets to add to the index."""

    first_new: DataFrame
    hits: DataFrame
    index_rows: DataFrame | None


def check_without_dedup(candidates: DataFrame) -> Checked:
    first = candidates.groupBy("doc_id").agg(F.min("seq").alias("new_seq"))
    return Checked(first, candidates.select("seq", F.lit(None).cast("string").alias("hit_id")), None)


def check_duplicates(
    candidates: DataFrame, index: Index | DataFrame | None, settings: NearDupSettings
) -> Checked:
    """Decide which of ``candidates`` (seq ≥ 0, doc_id, text; none stored yet) are new.

    What the index holds is older than any event of a batch. Each distinct text asks it once, through the slots of its
    own first shingles; who finds another document there is answered, and the others are compared with each other.

    An event is checked unless an earlier event of its id was new. With one text per id every first
    event is checked and one pass decides all. Otherwise the passes repeat with the events known to
    be checked until nothing changes; each pass settles at least the next undecided event.
    """
    sets = land(shingle_sets(candidates, settings))
    members, copies = text_classes(sets)
    classes = named_sets(sets)
    nodes = cut(members.groupBy("doc_id", "cls").agg(F.min("seq").alias("seq")))
    stored = None
    asks = nodes
    if index is not None:
        stored = cut(probe(classes, FrameIndex(index) if isinstance(index, DataFrame) else index, settings, copies))
        other = F.col("doc_id") == F.col("id1")
        told = nodes.join(stored, "cls").select(
            "doc_id", "cls", "seq", F.when(other, F.col("id2")).otherwise(F.col("id1")).alias("hit_id"))
        told = cut(told.where("hit_id is not null"))
        asks = cut(nodes.join(told.select("doc_id", "cls"), ["doc_id", "cls"], "left_anti"))
    tokens = class_tokens(classes, settings, copies=copies)

    opening = nodes.groupBy("doc_id").agg(F.min("seq").alias("_first"))
    checked = nodes.join(opening, "doc_id").withColumn("checked", F.col("seq") == F.col("_first")).drop("_first")
    several_texts = not nodes.groupBy("doc_id").count().where("count > 1").isEmpty()
    while True:
        findable = checked.where("checked").select("doc_id", "cls", "seq")
        answers = earliest_hits(tokens, findable, asks, settings).select("doc_id", "cls", "seq", "hit_id")
        answers = cut(answers if stored is None else answers.unionByName(told))
        first_new = answers.where("hit_id is null").groupBy("doc_id").agg(F.min("seq").alias("new_seq"))
        if not several_texts:
            break
        now = cut(
            checked.withColumnRenamed("checked", "before").join(first_new, "doc_id", "left")
            .withColumn("checked", F.col("new_seq").isNull() | (F.col("seq") <= F.col("new_seq")))
            .drop("new_seq")
        )
        settled = now.where("before <> checked").isEmpty()
        checked = now.drop("before")
        if settled:
            break

    hits = members.join(answers.select("doc_id", "cls", "hit_id"), ["doc_id", "cls"]).select("seq", "hit_id")
    # Of equal texts, two documents can be anybody's earliest match: the first, and the first other than the asker.
    holders = two_earliest(checked.where("checked").select("cls", "doc_id", "seq"), "cls")
    if stored is not None:
        holders = holders.join(stored.where("held").select("cls"), "cls", "left_anti")
    kept = holders.select(F.explode(F.array("seq1", "seq2")).alias("seq")).where("seq is not null")
    numbered = sets.where("seq is not null")
    # nearly all texts are kept, so their arrays stay in place
    return Checked(first_new, hits, outside(numbered, numbered.select("seq").join(kept, "seq", "left_anti"), "seq"))


@dataclass(frozen=True)
class Decisions:
    """Outcome of a batch.

    ``events``: one row per accepted event — seq, doc_id, target_id, outcome, duplicate_of,
    target_change (UPDATE/NOOP of the original a duplicate's overrides went to), operation, message,
    run_annotators, overrides. ``messages``: (target_id, seq, overrides, change) applied to
    stored documents. ``new_documents``: (seq, doc_id, doc, overrides), overrides merged into doc.
    ``stored_targets``: the stored documents among the messages' targets, in the corpus schema.
    ``index_rows``: additions to the shingle index.
    """

    events: DataFrame
    messages: DataFrame
    new_documents: DataFrame
    stored_targets: DataFrame
    index_rows: DataFrame | None


def decide(
    accepted: DataFrame,
    corpus: Corpus,
    tenant_docs: DataFrame,
    index: Index | DataFrame | None = None,
    settings: IngestSettings | None = None,
) -> Decisions:
    """Decide all events of a batch (see :func:`foliary.operators.routing.read_events`)."""
    settings = settings or IngestSettings()
    stored_ids = cut(
        stored_ids_of(corpus, accepted.select("target_id")).toDF("target_id")
    )
    slim = accepted.select("seq", "doc_id", "target_id", "overrides", "error")
    events = slim.join(stored_ids.withColumn("_stored", F.lit(True)), "target_id", "left").withColumn(
        "_stored", F.coalesce("_stored", F.lit(False))
    )
    candidates = outside(accepted.where("error is null"), stored_ids, "target_id").select(
        "seq", F.col("target_id").alias("doc_id"), F.col("doc.extracted_text").alias("text"))
    if settings.dedup is None:
        check = check_without_dedup(candidates)
    else:
        check = check_duplicates(candidates, index, settings.dedup)
    first_new = cut(check.first_new.select(F.col("doc_id").alias("target_id"), "new_seq"))

    hits = check.hits.withColumn("_has_text", F.lit(True))
    placed = events.join(first_new, "target_id", "left").join(hits, "seq", "left")
    is_new = F.col("seq") == F.col("new_seq")
    existing = F.col("_stored") | F.coalesce(F.col("seq") > F.col("new_seq"), F.lit(False))
    outcome = (
        F.when(F.col("error").isNotNull(), "ERROR")
        .when(existing, "EXISTING")
        .when(is_new, "NEW")
        .when(F.col("_has_text").isNull(), "ERROR")
        .otherwise("DUPLICATE")
    )
    placed = cut(placed.withColumn("outcome", outcome))

    # A duplicate's overrides go to its earliest match when that one is stored by then.
    duplicate = F.col("outcome") == "DUPLICATE"
    originals = (
        stored_ids_of(corpus, placed.where(duplicate).select("hit_id"))
        .select(F.col("document_id").alias("hit_id"), F.lit(-1).cast("bigint").alias("since"))
        .unionByName(first_new.select(F.col("target_id").alias("hit_id"), F.col("new_seq").alias("since")))
    )
    # Only duplicates take part in the join: the others have no match to look up.
    nowhere = F.lit(None).cast("string")
    routed = cut(
        placed.where(duplicate).join(originals, "hit_id", "left")
        .withColumn("_applies_to", F.when(F.col("since") < F.col("seq"), F.col("hit_id"))).drop("since")
        .unionByName(placed.where(~duplicate).withColumn(
            "_applies_to", F.when(F.col("outcome") == "EXISTING", F.col("target_id")).otherwise(nowhere)
        ))
    )
    messages = routed.where("_applies_to is not null").select(
        F.col("_applies_to").alias("target_id"), "seq", "overrides"
    )
    # wide rows, made once and read by all that follows
    new_documents = land(
        accepted.join(first_new, (accepted["target_id"] == first_new["target_id"]) & (F.col("seq") == F.col("new_seq")))
        .where("error is null")
        .select("seq", accepted["target_id"].alias("doc_id"), merge_overrides(F.col("doc"), F.col("overrides")).alias("doc"), "overrides")
    )
    # the only read of stored documents: those that got a message
    stored_targets = land(stored_documents(corpus, messages.select("target_id")))
    changes = cut(
        messages.join(
            change_log(messages, target_state(messages, stored_targets, tenant_docs, new_documents)).select("target_id", "seq", "change"),
            ["target_id", "seq"],
        )
    )
    decided = (
        routed.join(changes.select("seq", "change"), "seq", "left")
        .select(
            "seq", "doc_id", "target_id",
            F.when(F.col("outcome") == "EXISTING", F.col("change")).otherwise(F.col("outcome")).alias("outcome"),
            F.when(duplicate, F.col("hit_id")).alias("duplicate_of"),
            F.when(duplicate, F.col("change")).alias("target_change"),
            F.when(F.col("error").isNotNull(), INGESTION)
            .when(F.col("outcome") == "ERROR", DEDUPLICATION)
            .when(duplicate & F.col("_applies_to").isNull(), INGESTION).alias("operation"),
            F.when(F.col("error").isNotNull(), F.col("error"))
            .when(F.col("outcome") == "ERROR", NO_TEXT)
            .when(duplicate & F.col("_applies_to").isNull(), ORIGINAL_NOT_STORED).alias("message"),
            ((F.col("outcome") == "NEW") | ((F.col("outcome") == "EXISTING") & F.col("overrides.run_annotators"))).alias("run_annotators"),
            "overrides",
        )
    )
    return Decisions(cut(decided), changes, new_documents, stored_targets, check.index_rows)


def target_state(
    messages: DataFrame, stored_targets: DataFrame, tenant_docs: DataFrame, new_documents: DataFrame
) -> DataFrame:
    """State of every message target before the batch's first message: labels, tenants, source URI, genre."""
    targets = messages.select("target_id").distinct()
    names = F.array().cast("array<string>")

    def or_none(column: str) -> Column:
        return F.coalesce(F.col(column), names)

    stored = stored_targets.select(
        F.col("document_id").alias("target_id"), "labels", "source_uri",
        F.col("extracted_metadata.stated_genre").alias("genre"), names.alias("given"),
    )
    fresh = new_documents.select(
        F.col("doc_id").alias("target_id"), "doc.labels", "doc.source_uri",
        F.col("doc.extracted_metadata.stated_genre").alias("genre"), F.col("overrides.tenants").alias("given"),
    )
    memberships = tenants_by_document(
        tenant_docs.join(targets.withColumnRenamed("target_id", "doc_id"), "doc_id", "left_semi")
    ).withColumnRenamed("doc_id", "target_id")
    return (
        stored.unionByName(fresh.join(targets, "target_id", "left_semi"))
        .join(memberships, "target_id", "left")
        .select(
            "target_id", or_none("labels").alias("labels"), "source_uri", "genre",
            F.array_union(or_none("tenants"), "given").alias("tenants"),
        )
    )
