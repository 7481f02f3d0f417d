"""Annotators: which run on which documents, running them, and attaching their results."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from foliary.functions.documents import (
    annotation_from_json,
    document_to_json,
    fill_tag_values,
    has_content,
    relabel,
    tags_fit,
)
from foliary.operators.outputs import update_notices
from foliary.schemas import ANNOTATION

ANNOTATE = "annotate"
RESULT, NONE, FAILED = "result", "none", "failed"

DEFS = (
    "label STRING, host STRING, port INT, post_process BOOLEAN, path STRING, "
    "retry_count INT, retry_pause_ms BIGINT"
)


# --- definitions ----------------------------------------------------------------------------

def annotator_defs(given: DataFrame, host: str | None, retry_count: int, retry_pause_ms: int) -> DataFrame:
    """Definitions ``(label, host, port, post_process, path)`` completed with the shared settings.

    A definition without a host gets the shared one; without that either it is an error. The
    result is a set.
    """
    missing = F.raise_error(F.concat(F.lit("an annotator needs a host of its own or a shared one: "), "label"))
    own = F.coalesce("host", F.lit(host).cast("string"))
    return given.select(
        "label", F.when(own.isNotNull(), own).otherwise(missing).alias("host"), "port", "post_process", "path",
        F.lit(retry_count).alias("retry_count"), F.lit(retry_pause_ms).cast("bigint").alias("retry_pause_ms"),
    ).distinct()


def enabled_annotators(defs: DataFrame, enabled: str | None) -> DataFrame:
    """Definitions named in a comma list; all of them when there is no list."""
    if enabled is None:
        return defs
    return defs.where(F.col("label").isin(enabled.strip().split(",")))


# --- what runs ------------------------------------------------------------------------------

def annotatable(documents: DataFrame) -> DataFrame:
    """Documents ``(doc_id, doc)`` that have text to annotate."""
    return documents.where(F.length("doc.extracted_text") > 0)


def annotation_queue(decided: DataFrame, enabled: bool = True) -> DataFrame:
    """Rows whose ``run_annotators`` flag is set; none when annotators are switched off."""
    return decided.where(F.col("run_annotators") & F.lit(enabled))


def fan_out(documents: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per document and annotator, without a join: ``position`` and ``label`` are added."""
    return documents.select("*", F.posexplode(F.array(*[F.lit(x) for x in labels])).alias("position", "label"))


# --- running --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Annotator:
    """One annotator: either ``column``, an expression doc struct → annotation struct (null for no
    result), or ``function``, a Python callable on the document's JSON object.

    The callable returns an annotation object, returns None for no result, or raises; it is called
    up to ``retry_count`` more times, in rounds over the failed documents of a batch, with a pause growing by
    ``retry_pause_ms`` before each round.
    """

    label: str
    column: Callable[[Column], Column] | None = None
    function: Callable[[dict], dict | None] | None = None
    post_process: bool = False
    retry_count: int = 6
    retry_pause_ms: int = 1000


#: A configuration has a few annotators; more rows than this are no configuration.
MOST_ANNOTATORS = 1000


def annotators_from_defs(
    defs: DataFrame,
    columns: Mapping[str, Callable[[Column], Column]] | None = None,
    functions: Mapping[str, Callable[[dict, Row], dict | None]] | None = None,
    enabled: str | None = None,
) -> list[Annotator]:
    """The annotators that definitions (see :func:`annotator_defs`) and the list of enabled labels ask for, by label.

    What an annotator does is registered under its label: an expression of the document in ``columns``, or in
    ``functions`` a callable that gets the document's JSON object and the definition (host, port, path). Post-processing
    and retries come from the definition. A label without either, or defined twice, is an error.
    """
    columns, functions = columns or {}, functions or {}
    rows = enabled_annotators(defs, enabled).orderBy("label").limit(MOST_ANNOTATORS + 1).collect()
    if len(rows) > MOST_ANNOTATORS:
        raise ValueError(f"more than {MOST_ANNOTATORS} annotators are defined")
    made: dict[str, Annotator] = {}
    for row in rows:
        if row.label in made:
            raise ValueError(f"{row.label} is defined twice")
        if row.label not in columns and row.label not in functions:
            raise ValueError(f"nothing is registered for the annotator {row.label}")
        function = functions.get(row.label)
        made[row.label] = Annotator(
            row.label, columns.get(row.label),
            None if function is None or row.label in columns else partial(_defined, function, row),
            bool(row.post_process), row.retry_count, row.retry_pause_ms)
    return list(made.values())


def _defined(function: Callable[[dict, Row], dict | None], definition: Row, document: dict) -> dict | None:
    return function(document, definition)


_RAW = "doc_id STRING, position INT, label STRING, status STRING, answer STRING, error STRING, attempts INT"


def _attempt(annotator: Annotator, document: dict) -> tuple[str, str | None, str | None]:
    try:
        answer = annotator.function(document)
        return (NONE, None, None) if answer is None else (RESULT, json.dumps(answer), None)
    except Exception as failure:  # an annotator may fail in any way; the document goes on
        return FAILED, None, f"{type(failure).__name__}: {failure}"


def _call_in_rounds(
    annotators: Sequence[Annotator], documents: list[dict], asked: list[Sequence[str] | None] | None = None
) -> dict[tuple[int, int], tuple]:
    """``(document, annotator) → (status, answer, error, attempts)`` for a batch of documents.

    ``asked`` names a document's annotators; None stands for all, of a document and of all documents.

    Each round asks again only where an annotator failed and has tries left, after one pause for the whole batch, the
    longest that any of these annotators wants.
    """
    settled: dict[tuple[int, int], tuple] = {}
    if asked is None:
        asked = [None] * len(documents)
    open_ = [(d, i) for d, names in enumerate(asked) for i, a in enumerate(annotators) if names is None or a.label in names]
    attempt = 0
    while open_:
        attempt += 1
        if attempt > 1:
            time.sleep(max(annotators[i].retry_pause_ms for i in {i for _, i in open_}) * (attempt - 1) / 1000)
        for d, i in open_:
            settled[d, i] = (*_attempt(annotators[i], documents[d]), attempt)
        open_ = [k for k in open_ if settled[k][0] == FAILED and attempt <= annotators[k[1]].retry_count]
    return settled


def _settle(rows: DataFrame, annotators: Sequence[Annotator]) -> DataFrame:
    """Common end of both kinds: relabel, drop empty results, fill in tag values."""
    post = [a.label for a in annotators if a.post_process]
    filling = F.col("label").isin(post) & F.col("annotation.tags").isNotNull() if post else F.lit(False)
    tags, text = F.col("annotation.tags"), F.col("text")
    named = relabel(F.col("annotation"), F.col("label"))
    usable = (F.col("status") == RESULT) & has_content(F.col("annotation"))
    misfit = usable & filling & ~F.coalesce(tags_fit(tags, text), F.lit(False))
    status = (
        F.when(F.col("status") == FAILED, FAILED).when(misfit, FAILED).when(usable, RESULT).otherwise(NONE)
    )
    done = F.when(filling, named.withField("tags", fill_tag_values(tags, text))).otherwise(named)
    return rows.select(
        "doc_id", "position", "label",
        status.alias("status"),
        F.when(status == RESULT, done).alias("annotation"),
        F.when(misfit, "tag offsets outside the text").otherwise(F.col("error")).alias("error"),
        "attempts",
    )


def annotate(documents: DataFrame, annotators: Sequence[Annotator], asked: str | None = None) -> DataFrame:
    """Run annotators on ``(doc_id, doc)``; documents without text are left out.

    ``asked`` is a column of ``documents``, the labels of the annotators to run on a document; null stands for all.

    Result, one row per document and annotator: doc_id, position, label, status (result, none,
    failed), annotation, error, attempts. Expression annotators of all kinds are evaluated in one
    pass over the documents, callables in one ``mapInPandas`` pass.
    """
    names = F.lit(None).cast("array<string>") if asked is None else F.col(asked)
    ready = annotatable(documents).select("doc_id", "doc", names.alias("asked"))
    parts = []
    place = {a.label: i for i, a in enumerate(annotators)}
    by_column = [a for a in annotators if a.column is not None]
    if by_column:
        rows = F.array(*[
            F.struct(
                F.lit(place[a.label]).alias("position"), F.lit(a.label).alias("label"),
                a.column(F.col("doc")).cast(ANNOTATION).alias("annotation"),
            )
            for a in by_column
        ])
        wanted = F.filter(rows, lambda r: F.col("asked").isNull() | F.array_contains("asked", r["label"]))
        evaluated = ready.select("doc_id", F.col("doc.extracted_text").alias("text"), F.inline(wanted))
        parts.append(_settle(evaluated.withColumns({
            "status": F.when(F.col("annotation").isNull(), NONE).otherwise(RESULT),
            "error": F.lit(None).cast("string"), "attempts": F.lit(1),
        }), by_column))
    by_function = [a for a in annotators if a.function is not None]
    if by_function:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                settled = _call_in_rounds(by_function, [json.loads(body) for body in batch["body"]], list(batch["asked"]))
                out = [
                    (doc_id, place[a.label], a.label, *settled[d, i], text)
                    for d, (doc_id, text) in enumerate(zip(batch["doc_id"], batch["text"])) for i, a in enumerate(by_function)
                    if (d, i) in settled
                ]
                yield pd.DataFrame(out, columns=[
                    "doc_id", "position", "label", "status", "answer", "error", "attempts", "text"
                ])

        sent = ready.select(
            "doc_id", F.col("doc.extracted_text").alias("text"), document_to_json(F.col("doc")).alias("body"), "asked"
        )
        answered = sent.mapInPandas(run, _RAW + ", text STRING")
        parts.append(_settle(
            answered.withColumn("annotation", annotation_from_json(F.col("answer"))), by_function
        ))
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results


# --- results --------------------------------------------------------------------------------

def annotation_complete(results: DataFrame, annotator_count: int) -> DataFrame:
    """``(doc_id, done, complete)``: whether every annotator has reported on a document."""
    return results.groupBy("doc_id").agg(F.count("*").alias("done")).withColumn(
        "complete", F.col("done") == annotator_count
    )


# --- runs over several batches ----------------------------------------------------------------

OPEN_RUNS = "doc_id STRING, label STRING, round INT"


def run_rows(results: DataFrame, open_before: DataFrame) -> DataFrame:
    """``(doc_id, label, status, round)`` of a batch's results.

    ``open_before`` (doc_id, label, round) are the annotators this batch asked again; all others start a run, round 1.
    """
    return results.join(open_before.select("doc_id", "label", "round"), ["doc_id", "label"], "left").select(
        "doc_id", "label", "status", (F.coalesce("round", F.lit(0)) + 1).cast("int").alias("round"))


def open_runs(rows: DataFrame, rounds: int) -> DataFrame:
    """``(doc_id, label, round)`` that a later batch asks again: failed, with rounds left."""
    return rows.where((F.col("status") == FAILED) & (F.col("round") < rounds)).select("doc_id", "label", "round")


def run_state(rows: DataFrame, annotator_count: int) -> DataFrame:
    """``(doc_id, done, failed, complete)`` from the rows of all batches (``run_rows`` with their ``batch``).

    An annotator stands as its newest answer has it; a run is complete when every annotator answered without failing.
    """
    failed = F.col("status") == FAILED
    newest = rows.groupBy("doc_id", "label").agg(F.max_by("status", "batch").alias("status"))
    return newest.groupBy("doc_id").agg(
        F.count_if(~failed).alias("done"), F.count_if(failed).alias("failed"),
    ).withColumn("complete", F.col("done") == annotator_count)


def additions(results: DataFrame) -> DataFrame:
    """``(doc_id, seq, annotation)`` to append to the stored documents."""
    return results.where(F.col("status") == RESULT).select(
        "doc_id", F.col("position").alias("seq"), "annotation"
    )


def annotation_errors(results: DataFrame) -> DataFrame:
    """``(doc_id, operation, error_msg, stacktrace)``: one per annotator that gave up."""
    return results.where(F.col("status") == FAILED).select(
        "doc_id", F.col("label").alias("operation"), F.col("error").alias("error_msg"),
        F.concat_ws(": ", F.lit(ANNOTATE), "error").alias("stacktrace"),
    )


def annotation_notices(
    documents: DataFrame, results: DataFrame, tenant_docs: DataFrame, ontologies: DataFrame, stream_updates: bool = True
) -> DataFrame:
    """``(key, value)`` per result: the document as it was before, plus this one annotation only.

    The notices have the form of all others, ontologies included.
    """
    if not stream_updates:
        results = results.where(F.lit(False))
    joined = documents.join(additions(results), "doc_id")
    grown = F.col("doc").withField(
        "annotations", F.array_append(F.col("doc.annotations"), F.col("annotation"))
    )
    return update_notices(joined.select("doc_id", grown.alias("doc")), tenant_docs, ontologies)


def definitions_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Configured annotators (label, host, port, post_process, path) as a frame."""
    return spark.createDataFrame(rows, "label STRING, host STRING, port INT, post_process BOOLEAN, path STRING")
