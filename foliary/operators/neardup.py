"""Near-duplicate detection: exact set similarity join on word shingles.

A text is the set of its distinct ``window``-word shingles; two texts are near copies when the
Jaccard similarity of their sets reaches the threshold. What a batch needs is, for every text, its
earliest near copy, and the work below is arranged so that a group of copies of any size costs a
number of comparisons linear in its size:

* texts with equal sets are one *class*; all later steps work on classes;
* classes join on the first shingles of each set only, frequent ones last (prefix filtering; the shorter
  set of a pair needs a shorter prefix), so about a tenth of the shingles leaves its task as rows; of those, shingles
  of one class only go before any pair is formed;
* a pair counts under the length condition the threshold implies, where the shingles from this one on can
  still make up the overlap it needs (positional filtering), and where the sets' parity sketches do not differ in more
  bits than near copies can;
* on each shingle, everyone is compared with the ``width`` earliest classes first. A class that
  finds its earliest copy there is settled on that shingle, so only what is left is compared with
  the remainder of the list. No candidate is dropped.

References: Chaudhuri et al. 2006, Bayardo et al. 2007 and Xiao et al. 2011 (prefix filtering),
Broder 1997 (shingling).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foliary.functions.once import once
from foliary.session import among, cut, land, outside

# Shingles multiply rows in a way size estimates do not see, so no side of these joins may be
# broadcast on an estimate. Merge joins also let adaptive execution split a hot shingle.
MERGE = "merge"


@dataclass(frozen=True)
class NearDupSettings:
    """Whole texts are compared; ``max_words`` looks at the first words only. The threshold is a whole percentage."""

    window: int = 10
    max_words: int | None = None
    threshold: int = 90
    width: int = 16

    @classmethod
    def from_options(cls, options: dict) -> NearDupSettings | None:
        """Settings from configuration; None when the mode is ``noop``."""
        mode = str(options.get("mode", "embedded")).lower()
        if mode == "noop":
            return None
        if mode == "rest":
            raise NotImplementedError("duplicate detection by a remote service is not supported")
        if mode != "embedded":
            raise ValueError(f"{mode} is not a supported duplicate detection mode")
        algorithm = str(options.get("algorithm", "shingleprint")).lower()
        if algorithm == "lsh":
            raise NotImplementedError("locality-sensitive hashing is not supported")
        if algorithm != "shingleprint":
            raise ValueError(f"{algorithm} is not a supported duplicate detection algorithm")
        words = options.get("max_words")
        return cls(
            window=int(options.get("window", 10)),
            max_words=None if words is None else int(words),
        )


# --- shingle sets -------------------------------------------------------------------------------

def words(text: Column, max_words: int | None) -> Column:
    """Words between white space. Only as much of the text is split as is looked at."""
    if max_words is None:
        return F.array_remove(F.split(text, r"\s+"), "")
    # One more piece for an empty one in front, one for the unsplit rest.
    return F.slice(F.array_remove(F.split(text, r"\s+", max_words + 2), ""), 1, max_words)


def shingle_sets(docs: DataFrame, settings: NearDupSettings) -> DataFrame:
    """``(seq, doc_id, text)`` → ``(seq, doc_id, n, k1, k2, shingles)``.

    ``shingles`` is the sorted set of shingle hashes, ``n`` its size, and ``k1, k2`` a 128-bit key
    of the set. A text shorter than the window is one shingle. Rows without text are dropped.
    """
    w = settings.window
    hashed = F.transform(words(F.col("text"), settings.max_words), lambda word: F.xxhash64(word))
    runs = once(hashed, lambda h: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - w, F.lit(0))),
        # the hash of the slice, without making it; places behind the end are null and leave a hash as it is
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(w)]),
    ))
    return (
        docs.where(F.col("text").rlike(r"\S"))
        .select(
            F.col("seq").cast("bigint").alias("seq"), "doc_id",
            F.array_distinct(F.sort_array(runs)).alias("shingles"),
        )
        .select(
            "seq", "doc_id", F.size("shingles").alias("n"),
            F.xxhash64("shingles").alias("k1"), F.xxhash64(F.lit(1), "shingles").alias("k2"),
            "shingles",
        )
    )


def text_classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shingle sets' members ``(seq, doc_id, cls)`` and the copies ``(cls)``: numbers that name no class.

    A class is named by the ``seq`` of its earliest member, whose set (see :func:`named_sets`) stands for it. Only the
    three key columns of the members are shuffled; all arrays stay where they are.
    """
    keys = ["n", "k1", "k2"]
    first = sets.groupBy(*keys).agg(F.min("seq").alias("cls"))
    members = cut(sets.select("seq", "doc_id", *keys).join(first, keys).select("seq", "doc_id", "cls"))
    own = members.select(F.col("seq").alias("cls"))
    return members, own.join(members.select("cls").distinct(), "cls", "left_anti").distinct()


def named_sets(sets: DataFrame) -> DataFrame:
    """All sets ``(cls, n, shingles)`` under their own ``seq``; those outside the copies are the classes."""
    return sets.where("seq is not null").select(F.col("seq").alias("cls"), "n", "shingles")


#: Bits of a set in four words: each the parity of the set's shingles that hash to it. Sets that differ in d shingles
#: have sketches that differ in d bits or fewer.
SKETCH = ("p0", "p1", "p2", "p3")


def sketched(sets: DataFrame) -> DataFrame:
    """``sets`` with the four words of their parity sketches."""
    def word(w: int) -> Column:
        def flip(seen: Column, h: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))
            return F.when(F.shiftright(h, 6).bitwiseAND(3) == w, seen.bitwiseXOR(bit)).otherwise(seen)
        return F.aggregate("shingles", F.lit(0).cast("bigint"), flip)

    return sets.withColumns({name: word(w) for w, name in enumerate(SKETCH)})


# --- tokens: the shingles a class can be found by -------------------------------------------------

def needed(n: Column, percent: int) -> Column:
    """Smallest overlap a set of size n must have with any near copy."""
    return F.floor((percent * n + 99) / 100).cast("int")


def _needed_by_shorter(n: Column, percent: int) -> Column:
    """Smallest overlap of a set of size n with a near copy at least as long."""
    return F.floor((2 * percent * n + 99 + percent) / (100 + percent)).cast("int")


@dataclass(frozen=True)
class ClassTokens:
    """``sets``: (cls, n, shingles) of all classes. ``tokens``: (shingle, cls, n, rest, short,
    p0..p3) rows to join on; ``rest`` counts the set's shingles from this one on in the common order, ``short`` marks
    those in the shorter prefix."""

    sets: DataFrame
    tokens: DataFrame


#: So many of the most frequent shingles come last in the common order, and lie in so many lists of a constant.
FREQUENT, FREQUENT_LISTS = 1 << 14, 1 << 13
#: Shingles beyond a prefix that are counted, too.
SPARE = 90


def _weight_of(classes: DataFrame, settings: NearDupSettings) -> Callable[[Column], Column] | None:
    """How often a shingle occurs, null for all but the most frequent ones; None without any.

    Shingles are counted by 31 bits, and only where they may get into a prefix unless more than ``SPARE`` others move out
    of it. The order of shingles decides how many pairs are looked at, never which are found.
    """
    def short_of(shingle: Column) -> Column:
        return F.pmod(shingle, F.lit(1 << 31)).cast("int")

    reach = F.col("n") - needed(F.col("n"), settings.threshold) + 1
    early = F.slice(F.sort_array("shingles"), F.lit(1), reach + SPARE)
    counted = classes.select(F.explode(early).alias("s")).select(short_of(F.col("s")).alias("s")).groupBy("s").agg(
        F.count("*").alias("df"))
    found = counted.where(F.col("df") > settings.width).orderBy(F.desc("df"), "s").limit(FREQUENT).collect()
    lists: list[list] = [[] for _ in range(FREQUENT_LISTS)]
    for row in found:
        lists[row.s % FREQUENT_LISTS].append({"s": row.s, "df": row.df})
    held = F.from_json(F.lit(json.dumps(lists)), "array<array<struct<s:int,df:bigint>>>")

    def weight(shingle: Column) -> Column:
        listed = F.get(held, F.pmod(shingle, F.lit(FREQUENT_LISTS)).cast("int"))
        return F.get(F.filter(listed, lambda entry: entry["s"] == short_of(shingle)), F.lit(0))["df"]

    return weight if found else None


def class_tokens(
    classes: DataFrame, settings: NearDupSettings, asked: DataFrame | None = None, copies: DataFrame | None = None
) -> ClassTokens:
    """Prefixes of all classes ``(cls, n, shingles)`` under one global shingle order (frequent ones last, then by hash).

    ``asked`` (cls) limits the work to shingles of classes somebody asks about; None asks about all. ``copies`` (cls)
    are left out of ``classes``.
    """
    percent = settings.threshold
    reach = F.col("n") - needed(F.col("n"), percent) + 1
    short_reach = F.col("n") - _needed_by_shorter(F.col("n"), percent) + 1
    weight = _weight_of(classes, settings)
    given = classes.withColumn("shingles", F.sort_array("shingles"))
    if weight is None:
        ordered = given.withColumn("_ordered", F.col("shingles"))
    else:
        frequent = F.filter("shingles", lambda s: weight(s).isNotNull())
        last = F.transform(F.sort_array(F.transform("_frequent", lambda s: F.struct(
            weight(s).alias("df"), s.alias("shingle")))), lambda w: w["shingle"])
        ordered = given.withColumn("_frequent", frequent).withColumn(
            "_ordered", F.concat(F.array_except("shingles", "_frequent"), last))
    rows = (
        sketched(ordered)
        .select("cls", "n", short_reach.alias("short_reach"), *SKETCH, F.posexplode(
            F.slice("_ordered", F.lit(1), reach)).alias("pos", "shingle"))
        .select(
            "shingle", "cls", "n", (F.col("n") - F.col("pos")).alias("rest"),
            (F.col("pos") + 1 <= F.col("short_reach")).alias("short"), *SKETCH)
    )
    # a set's rows stand together, so its sketch is stored about once
    rows = land(rows if copies is None else outside(rows, copies, "cls"))
    counted = rows
    if asked is not None:
        wanted = rows.join(asked, "cls", "left_semi").select("shingle").distinct()
        counted = rows.join(wanted.hint(MERGE), "shingle", "left_semi")
    shared = counted.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1").select("shingle")
    tokens = cut(rows.join(shared.hint(MERGE), "shingle", "left_semi"))
    return ClassTokens(classes.select("cls", "n", "shingles"), tokens)


# --- joining ----------------------------------------------------------------------------------

def _verified(pairs: DataFrame, tokens: ClassTokens, percent: int) -> DataFrame:
    """Keep the (asker, cls) pairs whose sets really reach the threshold.

    Only the sets of the pairs' classes leave their place.
    """
    pairs = cut(pairs)
    met = pairs.select("cls").unionByName(pairs.select(F.col("asker").alias("cls"))).distinct()
    sets = cut(among(tokens.sets, met, "cls"))
    left = sets.select(F.col("cls").alias("asker"), F.col("n").alias("_n1"), F.col("shingles").alias("_s1"))
    right = sets.select("cls", F.col("n").alias("_n2"), F.col("shingles").alias("_s2"))
    common = F.size(F.array_intersect("_s1", "_s2"))
    return (
        pairs.join(left.hint(MERGE), "asker").join(right.hint(MERGE), "cls")
        .where(100 * common >= percent * (F.col("_n1") + F.col("_n2") - common))
        .select("asker", "cls")
    )


def _lanes(tokens: DataFrame, asking: bool) -> DataFrame:
    """Rows per join lane. Lane 1 joins shorter (or equal) found sets with longer askers, lane 2
    longer found sets with shorter askers; the shorter side takes part with its short prefix."""
    both, alone = F.array(F.lit(1), F.lit(2)), F.array(F.lit(1 if asking else 2))
    return tokens.withColumn("lane", F.explode(F.when(F.col("short"), both).otherwise(alone)))


def _fits(percent: int) -> Column:
    """Whether two sets that share this shingle can be near copies by their sizes and its places in them.

    On the first shingle that a pair shares, all it shares lies from there on in both sets. So a pair that could
    reach the threshold passes there, and may fail on its later shingles without being lost.
    """
    n, m = F.col("n"), F.col("asker_n")
    sizes = F.when(F.col("lane") == 1, (n <= m) & (100 * n >= percent * m)).otherwise(
        (m < n) & (100 * m >= percent * n)
    )
    enough = F.lit(100 + percent).cast("bigint") * F.least("rest", "asker_rest") >= F.lit(percent).cast("bigint") * (n + m)
    return (F.col("cls") != F.col("asker")) & sizes & enough


def _sketches_fit(percent: int) -> Column:
    """Whether the sets differ in no more bits of their sketches than two near copies of their sizes can."""
    total = F.col("n") + F.col("asker_n")
    overlap = F.floor((percent * total + 99 + percent) / (100 + percent))
    differing = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"asker_{p}"))) for p in SKETCH), F.lit(0))
    return differing <= total - 2 * overlap


def _as_askers(tokens: DataFrame) -> DataFrame:
    """The tokens of classes that ask."""
    return tokens.select(
        "shingle", F.col("cls").alias("asker"), F.col("n").alias("asker_n"), F.col("rest").alias("asker_rest"), "short",
        *[F.col(p).alias(f"asker_{p}") for p in SKETCH])


def _candidates(asking: DataFrame, found_by: DataFrame, percent: int, extra: Column | None = None) -> DataFrame:
    """Pairs (asker, cls) that share a shingle on which they fit."""
    fits = _fits(percent) if extra is None else _fits(percent) & extra
    if SKETCH[0] in found_by.columns and f"asker_{SKETCH[0]}" in asking.columns:
        fits = fits & _sketches_fit(percent)
    return asking.join(found_by.hint(MERGE), ["shingle", "lane"]).where(fits).select("asker", "cls").distinct()


def two_earliest(entries: DataFrame, key: str) -> DataFrame:
    """Per ``key`` the earliest entry (seq1, id1) and the earliest of another document (seq2, id2)."""
    ranked = (
        entries.groupBy(key, "doc_id").agg(F.min("seq").alias("seq"))
        .withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy("seq", "doc_id")))
        .where("_rank <= 2")
    )
    first, second = F.col("_rank") == 1, F.col("_rank") == 2
    return ranked.groupBy(key).agg(
        F.max(F.when(first, F.col("seq"))).alias("seq1"), F.max(F.when(first, F.col("doc_id"))).alias("id1"),
        F.max(F.when(second, F.col("seq"))).alias("seq2"), F.max(F.when(second, F.col("doc_id"))).alias("id2"),
    )


def _as_entries(two: DataFrame, key: str) -> DataFrame:
    both = F.array(
        F.struct(F.col("seq1").alias("seq"), F.col("id1").alias("doc_id")),
        F.struct(F.col("seq2").alias("seq"), F.col("id2").alias("doc_id")),
    )
    return two.select(key, F.inline(both)).where("seq is not null")


def _beyond_leading(
    asks: DataFrame, askers: DataFrame, asking: DataFrame, found_by: DataFrame, rest_from: DataFrame,
    best: DataFrame, percent: int,
) -> DataFrame:
    """Candidate pairs past the leading classes of a list, for askers that could still improve there.

    Nothing from ``seq1`` on can improve an asker, unless it is that document itself asking again;
    then it is ``seq2``. Lists without anything earlier than that are done for this asker.
    """
    returning = (
        asks.join(best, F.col("cls") == F.col("asker"))
        .where((F.col("doc_id") == F.col("id1")) & (F.col("seq") > F.col("seq1")))
        .select("asker").distinct().withColumn("returning", F.lit(True))
    )
    bound = F.when(F.col("returning"), F.col("seq2")).otherwise(F.col("seq1"))
    limits = (
        askers.join(best, "asker", "left").join(returning, "asker", "left")
        .select("asker", F.least("last_ask", F.coalesce(bound, F.col("last_ask"))).alias("until"))
    )
    open_tokens = (
        asking.drop("last_ask").join(rest_from.hint(MERGE), ["shingle", "lane"]).join(limits, "asker")
        .where(F.col("rest_seq") < F.col("until"))
    )
    open_ = (F.col("seq1") >= F.col("rest_seq")) & (F.col("seq1") < F.col("until"))
    return _candidates(open_tokens, found_by.drop("short"), percent, open_)


def earliest_hits(
    tokens: ClassTokens, entries: DataFrame, asks: DataFrame, settings: NearDupSettings
) -> DataFrame:
    """For every ask the earliest entry of another document whose text is a near copy.

    ``entries``: (doc_id, cls, seq) texts that can be found. ``asks``: (doc_id, cls, seq). Result:
    asks plus ``hit_seq, hit_id`` (null without a hit); only entries with ``seq`` below the ask count.
    """
    percent = settings.threshold
    holders = cut(two_earliest(entries, "cls"))
    askers = asks.groupBy(F.col("cls").alias("asker")).agg(F.max("seq").alias("last_ask"))

    found_by = _lanes(tokens.tokens.join(holders.select("cls", "seq1"), "cls"), asking=False)
    asking = _lanes(
        _as_askers(tokens.tokens).join(askers, "asker"),
        asking=True,
    ).drop("short")

    ranked = found_by.withColumn(
        "_rank", F.row_number().over(W.partitionBy("shingle", "lane").orderBy("seq1"))
    ).where(F.col("_rank") <= settings.width + 1)
    ranked = cut(ranked)
    leading = ranked.where(F.col("_rank") <= settings.width).drop("_rank", "short")
    rest_from = ranked.where(F.col("_rank") > settings.width).select(
        "shingle", "lane", F.col("seq1").alias("rest_seq")
    )
    pairs = _candidates(asking, leading, percent, F.col("seq1") < F.col("last_ask"))
    found = cut(_verified(pairs, tokens, percent))

    own = _as_entries(holders, "cls").withColumnRenamed("cls", "asker").join(
        askers.select("asker"), "asker", "left_semi"
    )

    def nearest(found: DataFrame) -> DataFrame:
        reached = found.join(holders, "cls")
        return two_earliest(
            _as_entries(reached, "asker").unionByName(own), "asker"
        )

    best = nearest(found)
    if not rest_from.isEmpty():
        best = cut(best)
        more = _beyond_leading(asks, askers, asking, found_by, rest_from, best, percent)
        best = nearest(found.unionByName(_verified(more, tokens, percent)))

    other = F.col("doc_id") == F.col("id1")
    hit_seq, hit_id = F.when(other, F.col("seq2")).otherwise(F.col("seq1")), F.when(other, F.col("id2")).otherwise(F.col("id1"))
    earlier = hit_seq < F.col("seq")
    return (
        asks.join(best.withColumnRenamed("asker", "cls"), "cls", "left")
        .select(
            "doc_id", "cls", "seq",
            F.when(earlier, hit_seq).alias("hit_seq"), F.when(earlier, hit_id).alias("hit_id"),
        )
    )


def near_duplicates(docs: DataFrame, settings: NearDupSettings | None = None) -> DataFrame:
    """``(seq, doc_id, text)`` with distinct ids → those with an earlier near copy.

    Columns: doc_id, seq, first_duplicate (id of the earliest near copy), score (always 1.00).
    """
    settings = settings or NearDupSettings()
    sets = land(shingle_sets(docs, settings))
    members, copies = text_classes(sets)
    tokens = class_tokens(named_sets(sets), settings, copies=copies)
    asks = members.select("doc_id", "cls", "seq")
    hits = earliest_hits(tokens, asks, asks, settings)
    return hits.where(F.col("hit_id").isNotNull()).select(
        "doc_id", "seq", F.col("hit_id").alias("first_duplicate"),
        F.lit(1).cast("decimal(3,2)").alias("score"),
    )


def copies_of(asked: DataFrame, docs: DataFrame, settings: NearDupSettings | None = None) -> DataFrame:
    """Every earlier near copy of the asked documents: (doc_id, duplicate_id, duplicate_seq).

    For looking up the full lists of chosen documents; the result has as many rows as there are
    copies, so ask for those you need. ``asked``: (doc_id); ``docs``: (seq, doc_id, text).
    """
    settings = settings or NearDupSettings()
    percent = settings.threshold
    sets = land(shingle_sets(docs, settings))
    members, copies = text_classes(sets)
    wanted = members.join(asked, "doc_id", "left_semi")
    askers = wanted.select("cls").distinct()
    tokens = class_tokens(named_sets(sets), settings, asked=askers, copies=copies)
    asking = _lanes(
        _as_askers(tokens.tokens.join(askers, "cls", "left_semi")),
        asking=True,
    ).drop("short")
    pairs = _candidates(asking, _lanes(tokens.tokens, asking=False).drop("short"), percent)
    same = askers.select(F.col("cls").alias("asker"), "cls")
    reached = _verified(pairs, tokens, percent).unionByName(same)
    return (
        wanted.select("doc_id", "seq", F.col("cls").alias("asker")).join(reached, "asker")
        .join(members.select(F.col("doc_id").alias("duplicate_id"), F.col("seq").alias("duplicate_seq"), "cls"), "cls")
        .where((F.col("duplicate_seq") < F.col("seq")) & (F.col("duplicate_id") != F.col("doc_id")))
        .select("doc_id", "duplicate_id", "duplicate_seq")
    )


# --- whole lists ------------------------------------------------------------------------------

@dataclass(frozen=True)
class CopyLists:
    """What the list of any document's near copies is read from, without a list of pairs of documents.

    ``members``: (doc_id, seq, cls), a row per document with text. ``links``: (cls, other), a row per two classes of
    different texts that are near copies, the later class first. Equal texts cost a row each; only texts that really
    differ, and are near each other, cost a row per pair.
    """

    members: DataFrame
    links: DataFrame

    def write(self, path: str) -> None:
        self.members.write.mode("overwrite").parquet(f"{path}/members")
        self.links.write.mode("overwrite").parquet(f"{path}/links")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CopyLists:
        return cls(spark.read.parquet(f"{path}/members"), spark.read.parquet(f"{path}/links"))

    def earlier(self, asked: DataFrame) -> DataFrame:
        """``(doc_id, seq, duplicate_id, duplicate_seq)``: all earlier near copies of the asked (doc_id), a row each."""
        wanted = self.members.join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
        classes = wanted.select("cls").distinct()
        forth = self.links.join(classes, "cls", "left_semi")
        back = self.links.select(F.col("other").alias("cls"), F.col("cls").alias("other")).join(classes, "cls", "left_semi")
        reached = forth.unionByName(back).unionByName(classes.select("cls", F.col("cls").alias("other")))
        found = self.members.select(F.col("doc_id").alias("duplicate_id"), F.col("seq").alias("duplicate_seq"), F.col("cls").alias("other"))
        return (
            wanted.join(reached.hint(MERGE), "cls").join(found.hint(MERGE), "other")
            .where((F.col("duplicate_seq") < F.col("seq")) & (F.col("duplicate_id") != F.col("doc_id")))
            .select("doc_id", "seq", "duplicate_id", "duplicate_seq")
        )

    def lists(self, asked: DataFrame) -> DataFrame:
        """``(doc_id, seq, duplicates)``: the ids of all earlier near copies in order of arrival, each once.

        Only of documents that have one. A list is one value, so ask for the documents whose lists a message needs;
        :meth:`earlier` gives rows.
        """
        once_each = self.earlier(asked).groupBy("doc_id", "seq", "duplicate_id").agg(F.min("duplicate_seq").alias("at"))
        listed = F.array_sort(F.collect_list(F.struct("at", "duplicate_id")))
        return once_each.groupBy("doc_id", "seq").agg(listed.getField("duplicate_id").alias("duplicates"))


def copy_lists(docs: DataFrame, settings: NearDupSettings | None = None) -> CopyLists:
    """The lists of all documents ``(seq, doc_id, text)``. Rows without text are in none; no rows, no lists."""
    settings = settings or NearDupSettings()
    percent = settings.threshold
    sets = land(shingle_sets(docs, settings))
    members, copies = text_classes(sets)
    tokens = class_tokens(named_sets(sets), settings, copies=copies)
    asking = _lanes(
        _as_askers(tokens.tokens),
        asking=True,
    ).drop("short")
    # a class is asked for once in each pair, by the later one
    pairs = _candidates(asking, _lanes(tokens.tokens, asking=False).drop("short"), percent, F.col("cls") < F.col("asker"))
    links = _verified(pairs, tokens, percent).select(F.col("asker").alias("cls"), F.col("cls").alias("other"))
    return CopyLists(members.select("doc_id", "seq", "cls"), cut(links))
