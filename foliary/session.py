"""Lineage cuts that survive the loss of an executor.

Both kinds write below ``spark.checkpoint.dir`` and leave their files there, like any reliable
checkpoint; whoever owns the folder clears it when the job is done.
"""

from __future__ import annotations

import json
import os
import tempfile
import zipfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home and return it.

    The folder named in ``spark.checkpoint.dir`` always wins. Only a local-mode session without
    that setting (tests) gets a folder of its own: on a cluster a machine-local path would be
    unreadable from the other machines.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="foliary-checkpoint-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so it is computed once and its lineage ends here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame) -> DataFrame:
    """Write ``df`` down as a Parquet table and go on from there.

    For wide rows of which later steps read a few columns each: unlike a checkpoint, the table is
    pruned and filtered at the scan.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the constant that :func:`among` tests wide rows with.
MARKS = 1 << 20


def _marked(ids: DataFrame, key: str) -> Column:
    """Whether ``key``'s bit is among those of ``ids`` (key), true for all of them; null for null."""
    bit = F.pmod(F.xxhash64(key), F.lit(MARKS)).cast("int")
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63))
    marks = [0] * (MARKS // 64)
    words = ids.where(F.col(key).isNotNull()).groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(flag).alias("word"))
    for row in words.collect():
        marks[row["at"]] = row["word"]
    held = F.from_json(F.lit(json.dumps(marks)), "array<bigint>")
    return F.col(key).isNotNull() & (F.get(held, F.shiftright(bit, 6)).bitwiseAND(flag) != 0)


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is in ``ids`` (key), for few ids and wide rows.

    The ids' hashes set bits in a constant of fixed size. Rows without their bit stay where they are; the others, among
    them all that are asked for, go to an exact semi join.
    """
    ids = cut(ids.select(key).distinct())
    return rows.where(_marked(ids, key)).join(ids.hint("merge"), key, "left_semi")


def outside(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not in ``ids`` (key); the counterpart of :func:`among`."""
    ids = cut(ids.select(key).distinct())
    marked = _marked(ids, key)
    return rows.where(~marked).unionByName(rows.where(marked).join(ids.hint("merge"), key, "left_anti"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors, once per application.

    Functions that run in Python workers are pickled by reference, so the workers must be able to
    import the package; on a cluster it need not be installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="foliary-package-"), "foliary-package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(home)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
