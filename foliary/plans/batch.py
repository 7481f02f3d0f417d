"""A whole batch of events, from reading to written tables; used by batch jobs and streams alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.operators import outputs as O
from foliary.operators.annotate import (
    Annotator,
    additions,
    annotate,
    annotation_errors,
    annotation_notices,
    annotation_queue,
    open_runs,
    run_rows,
)
from foliary.operators.ligatures import DEFAULT_WORDS, ArrivalLexicon, Lexicon, word_sightings
from foliary.operators.routing import read_events
from foliary.operators.tables import append_annotations, search_part
from foliary.plans.core import Preprocessor, apply_decisions, tenant_additions
from foliary.plans.ingest import Decisions, IngestSettings, decide, stored_documents
from foliary.session import cut
from foliary.sources.feeds import DEAD_LETTER_TOPIC, DUPLICATE_TOPIC, UPDATE_TOPIC
from foliary.sources.store import CorpusStore


@dataclass(frozen=True)
class BatchSettings:
    ingest: IngestSettings = field(default_factory=IngestSettings)
    preprocessors: Sequence[Preprocessor] = ()
    annotators: Sequence[Annotator] = ()
    #: So many batches ask a failing annotator about a document before its run is given up.
    annotation_rounds: int = 3
    stream_annotation_updates: bool = True
    lexicon_words: Sequence[str] = DEFAULT_WORDS
    #: More words to repair texts with, from ``(doc_id, text)``; they count from the start.
    lexicon_texts: DataFrame | None = None
    #: So many documents stored before a text make a word of what they hold.
    lexicon_min_docs: int = 2
    scope: str = "corpus"


@dataclass(frozen=True)
class BatchResult:
    decisions: Decisions
    changed: DataFrame
    rejected: DataFrame


def run_batch(
    events: DataFrame,
    store: CorpusStore,
    batch: int | str,
    processed_at: Column,
    settings: BatchSettings | None = None,
    labels=None,
    ontologies: DataFrame | None = None,
) -> BatchResult:
    """Decide, process and write one batch of ``(seq, doc_id, value)`` events.

    ``batch`` is the batch's own name; the store gives each name a number, in the order of arrival.

    Every table gets one folder for the batch, so a batch that is run again after a failure leaves
    the same tables behind.
    """
    settings = settings or BatchSettings()
    batch = store.number(f"batch {batch}")
    accepted, rejected = read_events(events, processed_at, labels, settings.ingest.detector)
    corpus = store.stored(batch)
    # Repeated memberships are harmless here: all uses collect sets of the documents at hand.
    tenants = store.read("tenant_docs", batch).drop("batch")
    index = store.shingle_index(batch) if batch > 0 and settings.ingest.dedup is not None else None
    decisions = decide(accepted, corpus, tenants, index, settings.ingest)

    arriving = decisions.new_documents.select("doc_id", "seq", F.col("doc.extracted_text").alias("text"))
    lexicon = ArrivalLexicon(
        Lexicon(settings.lexicon_texts, settings.lexicon_min_docs, tuple(settings.lexicon_words)), arriving,
        store.read("lexicon", batch) if batch > 0 else None, settings.lexicon_min_docs)
    changed = cut(apply_decisions(decisions, lexicon, settings.preprocessors))
    memberships = cut(tenant_additions(decisions))
    now_ms = F.unix_millis(processed_at)

    documents = changed.select(F.col("document_id").alias("doc_id"), F.struct(*changed.columns).alias("doc"))
    # Documents that got nothing but NOOP messages are not announced.
    announced = documents.join(_touched(decisions), "doc_id", "left_semi")
    all_tenants = tenants.unionByName(memberships)
    if ontologies is None:
        ontologies = store.spark.createDataFrame([], "tenant STRING, id STRING, version INT")
    notices = _topic(O.update_notices(announced, all_tenants, ontologies), UPDATE_TOPIC).unionByName(
        _topic(O.duplicate_notices(decisions.events), DUPLICATE_TOPIC)
    )
    status = O.core_status(decisions.events, now_ms, settings.scope)
    letters = O.dead_letters(decisions.events, now_ms)

    if settings.annotators:
        queue = cut(annotation_queue(_run_flags(decisions)).select("doc_id").distinct())
        labels = [a.label for a in settings.annotators]
        again = cut(store.open_runs(batch).where(F.col("label").isin(labels)).join(queue, "doc_id", "left_anti"))
        waiting = stored_documents(corpus, again.select("doc_id")).join(
            changed.select("document_id"), "document_id", "left_anti")
        changed = cut(changed.unionByName(waiting))
        documents = changed.select(F.col("document_id").alias("doc_id"), F.struct(*changed.columns).alias("doc"))
        asked = queue.withColumn("asked", F.lit(None).cast("array<string>")).unionByName(
            again.groupBy("doc_id").agg(F.collect_list("label").alias("asked")))
        results = cut(annotate(documents.join(asked, "doc_id"), settings.annotators, "asked"))
        runs = cut(run_rows(results, again))
        store.append("annotation_runs", runs, batch)
        store.set_open_runs(open_runs(runs, settings.annotation_rounds), batch)
        changed = append_annotations(changed, additions(results))
        notices = notices.unionByName(_topic(
            annotation_notices(documents, results, all_tenants, ontologies, settings.stream_annotation_updates), UPDATE_TOPIC
        ))
        status = status.unionByName(O.annotator_status(results, now_ms, settings.scope))
        letters = letters.unionByName(
            annotation_errors(results).withColumn("timestamp", now_ms.cast("bigint"))
        )
    letters = cut(letters)
    notices = notices.unionByName(_topic(O.dead_letter_messages(letters), DEAD_LETTER_TOPIC))

    store.append("rejected", rejected, batch)
    store.append("decisions", decisions.events, batch)
    store.append("pipeline_status", status, batch)
    store.append("dead_letters", letters, batch)
    store.append("notices", notices, batch)
    store.append("tenant_docs", memberships, batch)
    store.append("lexicon", word_sightings(arriving), batch)
    if decisions.index_rows is not None:
        store.add_to_index(decisions.index_rows, batch, settings.ingest.dedup)
    view = changed.select(F.col("document_id").alias("doc_id"), F.struct(*changed.columns).alias("doc"))
    fresh = decisions.new_documents.select(F.col("doc_id").alias("document_id"), F.lit(True).alias("_new"))
    parts = O.search_rows(view, all_tenants).join(fresh, "document_id", "left")
    store.append("search_parts", search_part(parts, F.col("_new").isNotNull()), batch)
    store.append("corpus", changed, batch)
    return BatchResult(decisions, changed, rejected)


def _topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.select(F.lit(topic).alias("topic"), "key", "value")


def _touched(decisions: Decisions) -> DataFrame:
    new = decisions.events.where("outcome = 'NEW'").select(F.col("target_id").alias("doc_id"))
    updated = decisions.messages.where("change = 'UPDATE'").select(F.col("target_id").alias("doc_id"))
    return new.unionByName(updated).distinct()


def _run_flags(decisions: Decisions) -> DataFrame:
    new = decisions.events.where("outcome = 'NEW'").select(
        F.col("target_id").alias("doc_id"), F.lit(True).alias("run_annotators")
    )
    again = decisions.messages.select(
        F.col("target_id").alias("doc_id"), F.col("overrides.run_annotators").alias("run_annotators")
    )
    return new.unionByName(again)
