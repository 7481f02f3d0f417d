"""Folding many override messages per document, in arrival order.

A document may receive any share of all messages, so nothing here puts all messages of one document
into one task: sets and last values are combined by partial aggregation, and "changed since the
previous message" is decided in two steps, first inside stretches of ``STRETCH`` sequence numbers,
then between the stretches' last values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

STRETCH = 1 << 20


def fold_overrides(messages: DataFrame) -> DataFrame:
    """``(target_id, seq, overrides)`` → one row per target.

    Columns: target_id, labels and tenants (distinct, sorted), source_uri (last given), genre (last),
    run_annotators (any), last_seq.
    """
    def names(field: str) -> Column:
        given = F.transform(f"overrides.{field}", lambda name: F.struct(F.lit(field).alias("field"), name.alias("name")))
        return F.coalesce(given, F.array().cast("array<struct<field:string,name:string>>"))

    # single names, not arrays of them: a target of very many messages keeps its distinct names only
    rows = messages.select(
        "target_id", "seq", "overrides.source_uri", "overrides.genre", "overrides.run_annotators",
        F.explode_outer(F.concat(names("labels"), names("tenants"))).alias("_n"))

    def union(field: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("_n.field") == field, F.col("_n.name"))))

    return rows.groupBy("target_id").agg(
        union("labels").alias("labels"),
        union("tenants").alias("tenants"),
        F.max_by("source_uri", F.when(F.col("source_uri").isNotNull(), F.col("seq"))).alias("source_uri"),
        F.max_by("genre", "seq").alias("genre"),
        F.max("run_annotators").alias("run_annotators"),
        F.max("seq").alias("last_seq"),
    )


def previous_values(rows: DataFrame, key: str, columns: list[str], stretch: int = STRETCH) -> DataFrame:
    """Add ``prev_<c>``: the last non-null value of each column among earlier rows of the key."""
    cut = rows.withColumn("_stretch", F.floor(F.col("seq") / stretch))
    inside = W.partitionBy(key, "_stretch").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy(key).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    ends = cut.groupBy(key, "_stretch").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"_end_{c}") for c in columns
    ]).select(key, "_stretch", *[
        F.last(f"_end_{c}", ignorenulls=True).over(across).alias(f"_before_{c}") for c in columns
    ])
    return (
        cut.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(f"_in_{c}") for c in columns])
        .join(ends, [key, "_stretch"])
        .select(*rows.columns, *[F.coalesce(f"_in_{c}", f"_before_{c}").alias(f"prev_{c}") for c in columns])
    )


def _introduced(messages: DataFrame, field: str, base: DataFrame) -> DataFrame:
    """``(target_id, seq)`` of messages that bring a label or tenant the target did not have yet."""
    first = (
        messages.select("target_id", "seq", F.explode(f"overrides.{field}").alias("name"))
        .groupBy("target_id", "name").agg(F.min("seq").alias("seq"))
    )
    had = base.select("target_id", F.explode(field).alias("name"))
    return first.join(had, ["target_id", "name"], "left_anti").select("target_id", "seq").distinct()


def change_log(messages: DataFrame, base: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Decide for every message whether it changes its target: ``change`` is UPDATE or NOOP.

    ``base``: state before the first message, (target_id, labels, tenants, source_uri, genre).
    A message changes its target when it brings a new tenant or label, another source URI, another
    genre, or asks for annotators to run. Adds flags new_labels, new_tenants, new_source_uri, new_genre.
    """
    flat = messages.select(
        "target_id", "seq",
        F.col("overrides.source_uri").alias("source_uri"),
        F.col("overrides.genre").alias("genre"),
        F.col("overrides.run_annotators").alias("run_annotators"),
    )
    before = previous_values(flat, "target_id", ["source_uri", "genre"], stretch)
    state = base.select("target_id", F.col("source_uri").alias("_base_uri"), F.col("genre").alias("_base_genre"))
    labels = _introduced(messages, "labels", base).withColumn("new_labels", F.lit(True))
    tenants = _introduced(messages, "tenants", base).withColumn("new_tenants", F.lit(True))
    no = F.lit(False)
    joined = (
        before.join(state, "target_id", "left")
        .join(labels, ["target_id", "seq"], "left").join(tenants, ["target_id", "seq"], "left")
        .select(
            "target_id", "seq", "run_annotators",
            F.coalesce("new_labels", no).alias("new_labels"),
            F.coalesce("new_tenants", no).alias("new_tenants"),
            (F.col("source_uri").isNotNull() & ~F.col("source_uri").eqNullSafe(F.coalesce("prev_source_uri", "_base_uri"))).alias("new_source_uri"),
            (~F.col("genre").eqNullSafe(F.coalesce("prev_genre", "_base_genre"))).alias("new_genre"),
        )
    )
    changed = F.col("new_labels") | F.col("new_tenants") | F.col("new_source_uri") | F.col("new_genre") | F.col("run_annotators")
    return joined.withColumn("change", F.when(changed, "UPDATE").otherwise("NOOP"))
