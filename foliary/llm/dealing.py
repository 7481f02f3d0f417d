"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Entry (i, j) of the matrix says how many rows of input partition i go to target j. Given the rows per
partition and the targets' sizes, the matrix of a uniform shuffle follows a multivariate
hypergeometric law; it is drawn by halving the partitions again and again. Each task walks down to
its own row from the seeds alone, so no process ever holds the matrix: what travels is the number of
rows per partition. A task permutes its targets locally, the rows are exchanged, and each target
permutes what it got.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import without, write_and_read
from foliary.session import ship_package

BLOCK_ROWS = 8_192
NUMPY_LIMIT = 10 ** 9


def near_equal(total: int, parts: int) -> np.ndarray:
    """Sizes at most one apart."""
    sizes = np.full(parts, total // parts, np.int64)
    sizes[:total % parts] += 1
    return sizes


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` from an urn; beyond numpy's limit by inversion around the mode."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    spread = int(40 * (1 + np.sqrt(draws * share * (1 - share) * (total - draws) / max(1, total - 1))))
    a, b = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(a, b, dtype=np.float64)  # log of P(k + 1) / P(k)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return a + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def multivariate(rng: np.random.Generator, sizes: np.ndarray, draws: int) -> np.ndarray:
    """How many of ``draws`` fall on each target, without replacement."""
    if int(sizes.sum()) < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(sizes, draws, method="marginals")
    out, rest = np.zeros(len(sizes), np.int64), int(sizes.sum())
    for j, size in enumerate(sizes.tolist()):
        out[j] = hypergeometric(rng, size, rest - size, draws)
        rest, draws = rest - size, draws - int(out[j])
    return out


def matrix_row(counts: np.ndarray, sizes: np.ndarray, i: int, seed: int) -> np.ndarray:
    """Row ``i`` of the communication matrix."""
    before = np.concatenate([[0], np.cumsum(counts)])
    low, high, sizes = 0, len(counts), sizes.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = multivariate(rng, sizes, int(before[middle] - before[low]))
        if i < middle:
            high, sizes = middle, left
        else:
            low, sizes = middle, sizes - left
    return sizes


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, seed: int = 0, block_rows: int = BLOCK_ROWS, settled: bool = False,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: a uniform shuffle, shard sizes at most one apart.

    A shard is cut into blocks of at most ``block_rows`` rows, which are the targets of the matrix, so
    no task needs a whole shard. ``slot`` counts from 0 without gaps within a shard.

    The rows of a partition must come in the same order whenever it is computed again. That holds for
    files (``settled=True``); other inputs are written to the shared folder first. Null or equal values
    make no difference, as rows are dealt by position; repeated rows are dealt one by one. Columns
    named ``shard`` or ``slot`` are replaced. Fewer rows than shards leave shards empty.
    """
    ship_package(docs.sparkSession)
    docs = without(docs, "shard", "slot", "__block", "__key")
    if not settled:
        docs = write_and_read(docs, "undealt")
    where = docs.select(F.spark_partition_id().alias("i")).groupBy("i").count().collect()  # a row per partition
    counts = np.zeros(max((r["i"] for r in where), default=-1) + 1, np.int64)
    for r in where:
        counts[r["i"]] = r["count"]
    total = int(counts.sum())
    per_shard = near_equal(total, shards)
    blocks = max(1, -(-int(per_shard[0]) // block_rows))
    sizes = np.concatenate([near_equal(n, blocks) for n in per_shard.tolist()])
    fields = [("shard", T.IntegerType()), ("__block", T.IntegerType()), ("__key", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in fields]])
    names = [f.name for f in schema.fields]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i = TaskContext.get().partitionId()
        row = matrix_row(counts, sizes, i, seed) if i < len(counts) else np.zeros(0, np.int64)
        rng = np.random.default_rng([seed, len(counts), i])
        targets = rng.permutation(np.repeat(np.arange(len(row), dtype=np.int32), row))
        at = 0
        for batch in batches:
            own = targets[at:at + batch.num_rows]
            if len(own) < batch.num_rows:
                raise RuntimeError("a partition has more rows than when it was counted")
            at += batch.num_rows
            keys = rng.integers(0, 1 << 62, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own // blocks, pa.int32()), pa.array(own % blocks, pa.int32()), pa.array(keys)],
                names=names)
        if at != len(targets):
            raise RuntimeError("a partition has fewer rows than when it was counted")

    # block b of a shard with s rows starts after b * (s // blocks) + min(b, s % blocks) rows
    rows = F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    start = (F.col("__block") * F.floor(rows / blocks)
             + F.least(F.col("__block").cast("long"), rows % blocks))
    order = Window.partitionBy("shard", "__block").orderBy("__key")
    dealt = docs.mapInArrow(label, schema)
    return dealt.withColumn("slot", (start + F.row_number().over(order) - 1).cast("long")).drop("__block", "__key")
