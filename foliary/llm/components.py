"""Connected components by alternating star contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.session import cut


def _towards_least(edges: DataFrame, larger: DataFrame) -> DataFrame:
    """Give every row of ``larger`` (u, v) the least neighbour of u, u itself included, as v's parent."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # a hub has many rows here and one on the other side: a merge join, which adaptive execution splits
    return larger.join(least.hint("merge"), "u").select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the least node it is connected with.

    ``edges`` has two columns of one type that can be ordered. Rows with a null end, loops and
    repeated edges add nothing. No edges, no rows. Each round hangs all larger neighbours of a node on
    its least one and then all smaller ones, until every tree is a star; the number of rounds grows
    with the logarithm of the size of a component. Rounds are cut by reliable checkpoints.
    """
    a, b = (F.col(c) for c in edges.columns)
    links = cut(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).distinct()
    )
    while True:
        seen = links.select(F.col("v").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(
            links.select("m", F.lit(0), F.lit(1)))
        seen = seen.groupBy("n").agg(F.sum("child").alias("children"), F.max("parent").alias("parent"))
        open_ = seen.where((F.col("children") > 1) | ((F.col("children") > 0) & (F.col("parent") > 0)))
        if open_.isEmpty():
            break
        both = links.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(links.select("m", "v"))
        large = _towards_least(both, both.where("v > u")).select("v", "m").distinct()
        # now v > m in every row: v's neighbours that are not larger
        down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _towards_least(down, down)
        links = cut(
            small.select("v", "m").unionAll(small.select(F.col("u").alias("v"), "m")).where("v != m").distinct())
    roots = links.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return links.select(F.col("v").alias("node"), F.col("m").alias("root")).unionAll(roots)
