"""Structured Streaming: every micro-batch goes through the same functions as a batch job."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from foliary.operators.neardup import NearDupSettings
from foliary.plans.batch import BatchSettings, run_batch
from foliary.plans.ingest import check_duplicates
from foliary.sources.store import CorpusStore


def ingest_stream(
    events: DataFrame,
    store: CorpusStore,
    checkpoint: str,
    settings: BatchSettings | None = None,
    labels=None,
    ontologies: DataFrame | None = None,
    processed_at: Callable[[], Column] = lambda: F.lit(datetime.now(timezone.utc)),
) -> DataStreamWriter:
    """Writer that ingests a stream of ``(seq, doc_id, value)`` events into the store.

    The checkpoint and the micro-batch id name the batch; a micro-batch that is repeated after a
    failure sees the tables as of its own start and replaces what its first attempt wrote, and a stream
    that starts on a filled store goes on after what is there.
    """
    def one(batch_events: DataFrame, batch_id: int) -> None:
        run_batch(batch_events, store, f"{batch_id} of {checkpoint}", processed_at(), settings, labels, ontologies)

    return events.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)


def dedup_stream(
    texts: DataFrame, store: CorpusStore, checkpoint: str, settings: NearDupSettings | None = None
) -> DataStreamWriter:
    """Writer that checks a stream of ``(seq, doc_id, text)`` against all texts seen before.

    Per text with an earlier near copy, a row goes to the ``decisions`` table; the checked texts
    join the store's inverted index, which is the stream's state; only what a micro-batch asks for is read.
    """
    settings = settings or NearDupSettings()

    def one(batch: DataFrame, batch_id: int) -> None:
        number = store.number(f"{batch_id} of {checkpoint}")
        index = store.shingle_index(number) if number > 0 else None
        checked = check_duplicates(batch, index, settings)
        found = batch.select("seq", "doc_id").join(checked.hits.where("hit_id is not null"), "seq")
        none = F.lit(None).cast("string")
        store.append("decisions", found.select(
            "seq", "doc_id", F.col("doc_id").alias("target_id"), F.lit("DUPLICATE").alias("outcome"),
            F.col("hit_id").alias("duplicate_of"), none.alias("target_change"), none.alias("operation"),
            none.alias("message"), F.lit(False).alias("run_annotators"),
        ), number)
        store.add_to_index(checked.index_rows, number, settings)

    return texts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
