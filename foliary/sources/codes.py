"""Code tables: code → label, one two-column CSV file per kind."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The lookup is a plan literal, so it is only built for tables up to this size (checked).
LOOKUP_LIMIT = 50_000
_BUCKETS = 1024
# What bytes that are no UTF-8 decode to; no code or label contains it.
REPLACEMENT = chr(0xFFFD)


def code_table(rows: DataFrame) -> DataFrame:
    """Normalise ``(kind, code, label)`` rows: keys in lower case, one label per key."""
    return (
        rows.where(F.col("code").isNotNull() & F.col("label").isNotNull())
        .groupBy("kind", F.lower("code").alias("code"))
        .agg(F.max("label").alias("label"))
    )


def read_code_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Read ``{kind: path}`` CSV files (UTF-8; malformed bytes are ignored) into one code table."""
    tables = []
    for kind, path in paths.items():
        rows = spark.read.schema("code STRING, label STRING").option("encoding", "UTF-8").csv(path)
        clean = rows.select(
            F.lit(kind).alias("kind"),
            F.translate("code", REPLACEMENT, "").alias("code"),
            F.translate("label", REPLACEMENT, "").alias("label"),
        )
        tables.append(clean)
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return code_table(merged)


def _entry_key(kind: Column, code: Column) -> Column:
    return F.concat(kind, F.lit("/"), code)


class LabelLookup:
    """Constant-time label lookup inside an expression, without a join or a shuffle.

    The table is spread over hash buckets of a few entries each and becomes one constant of the
    plan. Tables above ``LOOKUP_LIMIT`` rows are refused here; :func:`with_labels` joins those.
    """

    def __init__(self, codes: DataFrame, limit: int = LOOKUP_LIMIT):
        key = _entry_key(F.col("kind"), F.col("code"))
        rows = (
            codes.select(F.pmod(F.hash(key), F.lit(_BUCKETS)).alias("b"), key.alias("k"), "label")
            .limit(limit + 1).collect()
        )
        if len(rows) > limit:
            raise ValueError(f"code table has more than {limit} rows; use with_labels or join_labels")
        buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
        for row in rows:
            buckets[row["b"]][row["k"]] = row["label"]
        self._buckets = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")

    def getItem(self, key: Column) -> Column:  # noqa: N802 - same name as Column.getItem
        """Label of a ``kind/code`` key; null when unknown."""
        return F.get(self._buckets, F.pmod(F.hash(key), F.lit(_BUCKETS)))[key]


def join_labels(coded: DataFrame, codes: DataFrame) -> DataFrame:
    """``(…, kind, code)`` rows with a nullable ``label``; the optimiser broadcasts a small table."""
    return coded.join(codes, ["kind", "code"], "left")


def with_labels(rows: DataFrame, row_id: str, keys: Column, codes: DataFrame, limit: int | None = None):
    """``rows`` and a label lookup for them: ``(rows, lookup)``.

    ``keys`` are the ``kind/code`` keys a row asks for. A table of up to ``limit`` rows becomes a plan constant.
    A larger one is joined with the distinct keys of each row, and ``rows`` get their labels as a map ``_labels``;
    ``row_id`` tells the rows apart. The labels are the same either way.
    """
    limit = LOOKUP_LIMIT if limit is None else limit
    if codes.limit(limit + 1).count() <= limit:
        return rows, LabelLookup(codes, limit)
    asked = rows.select(row_id, F.explode(F.array_distinct(keys)).alias("_key"))
    known = codes.select(_entry_key(F.col("kind"), F.col("code")).alias("_key"), "label")
    # a code found in very many rows meets one row here, so adaptive execution may split it
    found = asked.join(known.hint("merge"), "_key")
    maps = found.groupBy(row_id).agg(F.map_from_entries(F.collect_set(F.struct("_key", "label"))).alias("_labels"))
    return rows.join(maps.hint("merge"), row_id, "left"), F.col("_labels")
