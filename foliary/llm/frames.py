"""Small helpers the operators share: columns, Arrow passes and per-worker state."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.session import checkpoint_dir, ship_package

_HELD: dict = {}


def held(key, build: Callable):
    """What ``build`` makes, kept by a Python worker for its later tasks. One value per kind of key."""
    kind = key[0]
    if _HELD.get(kind, (None, None))[0] != key:
        _HELD[kind] = (key, build())
    return _HELD[kind][1]


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder name of its own in the place all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid4().hex}"


def write_and_read(df: DataFrame, kind: str = "table") -> DataFrame:
    """Cut the lineage with a written table."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names the operator is about to use (in any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[column(df, c) for c in df.columns if c.lower() not in taken])


def column(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def fold_of(doc_id: Column) -> Column:
    """Fold 0 to 3 of a document; fold 2 is held out."""
    return F.crc32(doc_id.cast("string")) % F.lit(4)


def add_columns(
    df: DataFrame, inputs: list[str], added: list[tuple[str, T.DataType]],
    make: Callable[..., Iterable], keep: list[str] | None = None,
    rows_at_once: int = 2048, chars_at_once: int = 4_000_000,
) -> DataFrame:
    """One Arrow pass over whole rows: ``make(*lists)`` returns one list per added column.

    Rows are handed over in slices of bounded rows and characters of the first input, so a run of long
    texts does not pile up in a Python worker. ``keep`` names the columns to keep (all by default);
    columns of an added name are replaced.
    """
    ship_package(df.sparkSession)
    taken = {n.lower() for n, _ in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    extra = [c for c in inputs if c not in kept]
    given = df.select(*[column(df, c) for c in kept], *[
        column(df, c).alias(f"__in{i}") for i, c in enumerate(extra)
    ])
    at = [kept.index(c) if c in kept else len(kept) + extra.index(c) for c in inputs]
    schema = T.StructType([*given.schema.fields[:len(kept)], *[T.StructField(n, t) for n, t in added]])
    width, kinds, names = len(kept), [t for _, t in added], [f.name for f in schema.fields]

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(t) for t in kinds]
        for batch in batches:
            for part in slices(batch, at[0], rows_at_once, chars_at_once):
                lists = make(*[part.column(i).to_pylist() for i in at])
                arrays = [pa.array(x, type=t) for x, t in zip(lists, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *arrays], names=names)

    return given.mapInArrow(passed, schema)


def slices(batch: pa.RecordBatch, text_at: int, rows: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows and by the characters of its column ``text_at``."""
    n = batch.num_rows
    if n == 0:
        return
    column = batch.column(text_at)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    else:
        sizes = [0] * n
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= rows or total + size > chars):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)
