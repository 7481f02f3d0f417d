"""Near copies by 64-bit fingerprints, found with a pigeonring filter.

Two fingerprints at Hamming distance t or less, cut into m > t segments on a ring, have a start segment from
which every chain of l consecutive segments differs in at most l * t / m bits. The chain of two is
used as join key: the start segment must be equal, and the next may differ in ``floor(2 t / m)`` bits,
so each fingerprint is stored once per start under both segments and asked for with every such
variant of the second. The longer chains prune what meets, and the full distance decides.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.components import components
from foliary.llm.frames import add_columns, column, without, write_and_read
from foliary.session import cut

SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Bit majority over the hashes of all word shingles, repeats included; 0 without words.

    A-Z count as a-z. Fewer words than a shingle holds make one shingle.
    """
    import xxhash

    words = text.encode().lower().split() if text else []  # bytes split at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - size + 1)
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, 65_536):  # bounded memory for very long texts
        hi = min(n, lo + 65_536)
        last = ends[size - 1 + lo:size - 1 + hi] or ends[-1:]
        found = [digest(joined[a:b - 1], SEED) for a, b in zip(starts[lo:hi], last)]
        octets = np.array(found, "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, text: str = "text", size: int = SHINGLE_WORDS, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or the columns ``keep``) with ``simhash``, a signed long of the fingerprint's bits.

    A null text has no words.
    """

    def make(texts: list) -> tuple[list[int]]:
        known: dict = {}
        for t in texts:
            if t not in known:
                value = fingerprint(t, size)
                known[t] = value - (1 << 64) if value >> 63 else value
        return ([known[t] for t in texts],)

    return add_columns(docs, [text], [("simhash", T.LongType())], make, keep)


def segments(radius: int, bits: int = 64) -> list[tuple[int, int]]:
    """(offset, width) of radius + 1 segments of nearly equal width."""
    m = radius + 1
    edges = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(value: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(value, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _keys(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """``(a, i, k)`` under which fingerprints are stored, and ``(b, i, k)`` under which they ask."""
    ring = segments(radius)
    m, value = len(ring), F.col(prints.columns[0])
    stored, asked = [], []
    for i, (offset, width) in enumerate(ring):
        after, next_width = ring[(i + 1) % m]
        base = F.shiftleft(_part(value, offset, width), next_width).bitwiseOR(_part(value, after, next_width))
        flips = [sum(1 << b for b in c) for k in range(2 * radius // m + 1) for c in combinations(range(next_width), k)]
        stored.append(F.struct(F.lit(i).alias("i"), base.alias("k")))
        asked.extend(F.struct(F.lit(i).alias("i"), base.bitwiseXOR(F.lit(x).cast("long")).alias("k")) for x in flips)
    # A few bytes a row become dozens of keys: spread the rows first, in as many parts as a shuffle has. Dealing
    # them by value would be left out as a repetition of the distinct before it, whose parts are merged.
    prints = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        prints.select(value.alias("a"), F.inline(F.array(*stored))),
        prints.select(value.alias("b"), F.inline(F.array(*asked))),
    )


def _near(a: Column, b: Column, start: Column, radius: int) -> Column:
    """The chains of three and more from segment ``start`` hold their budgets, and so does the whole ring."""
    ring, apart = segments(radius), a.bitwiseXOR(b)
    m, chains = len(ring), F.lit(True)
    for i in range(m):
        chain, so_far = F.lit(True), F.bit_count(_part(apart, *ring[i]))
        for length in range(2, m):
            so_far = so_far + F.bit_count(_part(apart, *ring[(i + length - 1) % m]))
            if length > 2:
                chain = chain & (so_far <= length * radius // m)
        chains = chains & ((start != i) | chain)
    return chains & (F.bit_count(apart) <= radius)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at distance ``radius`` or less.

    ``prints`` has one column of distinct signed longs. A pair may come more than once, from
    different starts of the ring. All pairs are asked for, so a crowded key gives many; where only the
    groups matter, ``groups`` does with fewer.
    """
    value = F.col(prints.columns[0])
    if radius == 0:
        return prints.select(value.alias("a"), value.alias("b")).where("a < b")
    index, probes = _keys(prints, radius)
    index = index.hint("merge")
    met = (index["i"] == probes["i"]) & (index["k"] == probes["k"]) & (F.col("a") < F.col("b"))
    return index.join(probes, met & _near(F.col("a"), F.col("b"), probes["i"], radius)).select("a", "b")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(simhash, group)`` for fingerprints that have links; ``group`` is the least of the component.

    Groups need links that connect them, not all pairs. Everyone who asks for a key first meets its least and
    its greatest fingerprint only; a key that stores no other is settled. What these links leave apart decides about the
    others: under each key the commonest group so far stands aside, and only fingerprints of different
    groups meet. A crowd of near copies is one group by then and costs time linear in its size, and
    no link between two groups is lost.
    """
    name = prints.columns[0]
    if radius == 0:
        return prints.select(F.col(name), F.col(name).alias("group")).where(F.lit(False))
    index, probes = _keys(prints.distinct(), radius)
    index = cut(index)
    heads = index.groupBy("i", "k").agg(F.min("a").alias("head"), F.max("a").alias("tail"))
    asking = write_and_read(
        probes.join(heads.hint("merge"), ["i", "k"]).where("head < tail or head != b"), "asking")
    first = asking.select("i", "b", F.explode(F.array("head", "tail")).alias("a"))
    near = _near(F.col("a"), F.col("b"), F.col("i"), radius) & (F.col("a") != F.col("b"))
    found = cut(first.where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    root = cut(components(found)).hint("merge")

    def rooted(rows: DataFrame, column: str) -> DataFrame:
        return rows.join(root.withColumnRenamed("node", column), column, "left").withColumn(
            "root", F.coalesce("root", column))

    crowded = heads.where("head < tail").select("i", "k")
    held = cut(rooted(index.join(crowded.hint("merge"), ["i", "k"]), "a").withColumnRenamed("root", "a_root"))
    sizes = held.groupBy("i", "k", "a_root").agg(F.count("*").alias("n"))
    common = sizes.groupBy("i", "k").agg(
        F.max_by("a_root", F.struct("n", "a_root")).alias("common"), F.count("*").alias("groups"))
    common = cut(common).hint("merge")
    held = held.join(common, ["i", "k"])
    others = rooted(asking.where("head < tail").select("b", "i", "k"), "b").withColumnRenamed("root", "b_root")
    # under a key of one group, its own members have nothing left to ask
    others = cut(others.join(common, ["i", "k"]).where("groups > 1 or b_root != common").drop("groups"))
    in_common, outside = F.col("a_root") == F.col("common"), F.col("b_root") != F.col("common")

    def meet(stored: DataFrame, ask: DataFrame) -> DataFrame:
        pairs = stored.select("i", "k", "a", "a_root").hint("merge").join(ask.select("i", "k", "b", "b_root"), ["i", "k"])
        pairs = pairs.where((F.col("a_root") != F.col("b_root")) & _near(F.col("a"), F.col("b"), F.col("i"), radius))
        return pairs.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))

    bridges = meet(held.where(in_common), others.where(outside)).unionAll(meet(held.where(~in_common), others))
    whole = components(found.unionAll(bridges.distinct()))
    return whole.select(F.col("node").alias(name), F.col("root").alias("group"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``simhash`` and ``component_id``.

    ``component_id`` is the smallest id among the rows reachable by links, the row's own included; null
    only if all of them are null. Equal texts share a fingerprint, so copies meet in an aggregation and
    never as pairs. Texts without words have fingerprint zero and are linked like any other. Columns
    of the two names are replaced; repeated rows stay.
    """
    marked = write_and_read(with_fingerprints(without(docs, "simhash", "component_id"), text, keep=keep), "marked")
    return marked.join(component_ids(marked, id_column, radius), "simhash", "left")


def component_ids(marked: DataFrame, id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``(simhash, component_id)``, one row per distinct fingerprint of ``marked``."""
    smallest = cut(marked.groupBy("simhash").agg(F.min(column(marked, id_column)).alias("smallest")))
    grouped = groups(smallest.select("simhash"), radius)
    joined = smallest.join(grouped, "simhash", "left").withColumn("group", F.coalesce("group", "simhash"))
    whole = joined.groupBy("group").agg(F.min("smallest").alias("component_id"))
    return joined.join(whole, "group").select("simhash", "component_id")


def hex_print(value: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The row with the smallest id of each component; of equal ids, one row. Null ids come last.

    Decisions are made on fingerprints and ids; whole rows are shuffled once, by a key without repeats.
    """
    taken = docs.select(*[column(docs, c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    taken = taken.withColumn("__row", F.monotonically_increasing_id())
    marked = write_and_read(with_fingerprints(taken, at[text]), "marked")
    slim = marked.select("simhash", "__row", F.col(at[id_column]).alias("id"))
    chosen = component_ids(slim, "id", radius)
    first = slim.join(chosen, "simhash").groupBy("component_id").agg(
        F.min_by("__row", F.struct(F.col("id").isNull(), F.col("id"), F.col("__row"))).alias("__row"))
    kept = marked.join(first.select("__row"), "__row", "left_semi")
    return kept.select(*[F.col(new).alias(old) for old, new in at.items()])
