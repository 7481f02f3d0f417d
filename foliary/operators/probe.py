"""Near copies of a batch's texts among those in a stored inverted index.

The order of shingles is fixed (by hash), so what is stored about a text never changes: its set, and one row for
each of the first n - needed(n) + 1 shingles, which every near copy shares one of. A row carries the place of the
shingle in the set and a parity sketch: 256 bits, each the parity of the shingles that hash to it. Sets that
differ in d shingles have sketches that differ in d bits or fewer, so the join itself drops nearly all pairs that
are no near copies, and none that are.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foliary.operators.neardup import MERGE, SKETCH, NearDupSettings, needed, sketched, two_earliest
from foliary.session import among, cut, land, outside

#: Ranges of shingles and groups of sets that are stored apart.
SLOTS, PARTS = 128, 64
#: Earliest candidates of a text that are verified first.
LEADING = 4


class Index(Protocol):
    """Texts checked before: rows of the inverted list by slot, and shingle sets by part."""

    def lists(self, slots: list[int], settings: NearDupSettings) -> DataFrame:
        """``(slot, shingle, pos, seq, n, p0..p3)`` of the asked slots."""

    def sets(self, parts: list[int]) -> DataFrame:
        """``(part, seq, doc_id, n, shingles)`` of the asked parts."""


def list_rows(sets: DataFrame, name: str, settings: NearDupSettings) -> DataFrame:
    """Rows ``(slot, shingle, pos, <name>, n, p0..p3)`` of the inverted list of ``(<name>, n, shingles)``."""
    first = F.slice("shingles", F.lit(1), F.col("n") - needed(F.col("n"), settings.threshold) + 1)
    rows = sketched(sets).select(name, "n", *SKETCH, F.posexplode(first).alias("pos", "shingle"))
    return rows.select(F.shiftrightunsigned("shingle", 57).cast("int").alias("slot"), "shingle", "pos", name, "n", *SKETCH)


def set_rows(sets: DataFrame) -> DataFrame:
    return sets.select(F.pmod("seq", F.lit(PARTS)).cast("int").alias("part"), "seq", "doc_id", "n", "shingles")


def _may_match(percent: int) -> Column:
    """For rows of an asking (a_*) and a stored set on a shared shingle: sizes, places and sketches allow a near copy.

    On the first shingle two sets share, 1 + the lesser rest bounds their overlap, so a pair is kept on that row if on any.
    """
    total = F.col("n") + F.col("a_n")
    overlap = F.floor((percent * total + 99 + percent) / (100 + percent))
    rest = F.least(F.col("n") - F.col("pos"), F.col("a_n") - F.col("a_pos"))
    differing = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"a_{p}"))) for p in SKETCH), F.lit(0))
    return (
        (100 * F.col("n") >= percent * F.col("a_n")) & (100 * F.col("a_n") >= percent * F.col("n"))
        & (rest >= overlap) & (differing <= total - 2 * overlap)
    )


def _asked_values(rows: DataFrame, name: str) -> list[int]:
    """The few numbers that name stored pieces."""
    return sorted(r[0] for r in rows.select(name).distinct().collect())


def _verified(pairs: DataFrame, classes: DataFrame, index: Index, percent: int) -> DataFrame:
    """``(cls, seq, doc_id, same)`` of the pairs (cls, seq) that reach the threshold."""
    pairs = cut(pairs)
    parts = _asked_values(pairs.select(F.pmod("seq", F.lit(PARTS)).cast("int").alias("part")), "part")
    stored = among(index.sets(parts), pairs, "seq").select("seq", "doc_id", "n", F.col("shingles").alias("_s"))
    met = among(classes, pairs.select("cls").distinct(), "cls")
    own = met.select("cls", F.col("n").alias("_n"), F.col("shingles").alias("_t"))
    common = F.size(F.array_intersect("_s", "_t"))
    compared = pairs.join(stored.hint(MERGE), "seq").join(own.hint(MERGE), "cls").withColumn("_c", common)
    return compared.where(100 * F.col("_c") >= percent * (F.col("n") + F.col("_n") - F.col("_c"))).select(
        "cls", "seq", "doc_id", ((F.col("_c") == F.col("n")) & (F.col("n") == F.col("_n"))).alias("same"))


def probe(
    classes: DataFrame, index: Index, settings: NearDupSettings, copies: DataFrame | None = None
) -> DataFrame:
    """The two earliest stored near copies, of different documents, of each text of ``(cls, n, shingles)``.

    Result: ``(cls, seq1, id1, seq2, id2, held)`` of texts that have one; the second may be null. ``held`` tells that two
    documents with this very text were seen. Only the slots of the texts' own first shingles and the parts of their
    candidates are read. The earliest candidates are verified first, and the others only of texts that
    still lack a second document. ``copies`` (cls) are left out of ``classes``.
    """
    percent = settings.threshold
    asking = list_rows(classes, "cls", settings)
    asking = land(asking if copies is None else outside(asking, copies, "cls"))
    slots = _asked_values(asking, "slot")
    asked = asking.select("slot", "shingle", "cls", F.col("pos").alias("a_pos"), F.col("n").alias("a_n"), *[
        F.col(p).alias(f"a_{p}") for p in SKETCH])
    stored = index.lists(slots, settings)
    pairs = stored.join(asked.hint(MERGE), ["slot", "shingle"]).where(_may_match(percent)).select("cls", "seq").distinct()
    pairs = cut(pairs)
    ranked = pairs.withColumn("_rank", F.row_number().over(W.partitionBy("cls").orderBy("seq"))).where(
        F.col("_rank") <= LEADING + 1)
    ranked = cut(ranked)
    hits = cut(_verified(ranked.where(F.col("_rank") <= LEADING).select("cls", "seq"), classes, index, percent))
    more = ranked.where(F.col("_rank") > LEADING).select("cls")
    if not more.isEmpty():
        enough = hits.groupBy("cls").agg(F.count_distinct("doc_id").alias("_ids")).where("_ids > 1")
        open_ = more.join(enough, "cls", "left_anti")
        rest = pairs.join(open_, "cls", "left_semi").join(ranked.select("cls", "seq"), ["cls", "seq"], "left_anti")
        hits = cut(hits.unionByName(_verified(rest, classes, index, percent)))
    held = hits.where("same").groupBy("cls").agg((F.count_distinct("doc_id") > 1).alias("held"))
    return two_earliest(hits.select("cls", "doc_id", "seq"), "cls").join(held, "cls", "left").withColumn(
        "held", F.coalesce("held", F.lit(False)))


class FrameIndex:
    """An index over a frame of shingle sets ``(seq, doc_id, n, shingles)``, for sets that fit no store."""

    def __init__(self, sets: DataFrame):
        self.frame = sets

    def lists(self, slots: list[int], settings: NearDupSettings) -> DataFrame:
        return list_rows(self.frame, "seq", settings).where(F.col("slot").isin(slots))

    def sets(self, parts: list[int]) -> DataFrame:
        return set_rows(self.frame).where(F.col("part").isin(parts))
