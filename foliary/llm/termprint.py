"""Document fingerprints: weighted term hashes vote on 64 signed bits, in DataFrame operations only.

Votes are counted two bits to a sum: a hash shifted by j and masked holds bit j in its lower and bit
j + 32 in its upper half, so 32 sums of longs count all 64 bits before anything is shuffled.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.frames import column, write_and_read

LANES = (1 << 32) + 1
HEAVIEST = 8
QUANTILES = 256
BUCKET_ROWS = 1_024


def terms_of(text: Column) -> Column:
    """Lower-cased words between white space; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\\s+"), lambda w: w != "")


def votes(term: Column) -> list[Column]:
    """The sums to aggregate: 32 of votes and one of weights. A longer word weighs more, up to 8."""
    weight = F.least(F.length(term), F.lit(HEAVIEST)).cast("long")
    hashed = F.xxhash64(term)
    sums = [F.sum(weight * F.shiftrightunsigned(hashed, j).bitwiseAND(F.lit(LANES))).alias(f"v{j}") for j in range(32)]
    return [*sums, F.sum(weight).alias("weight")]


def fingerprint_of() -> Column:
    """A signed long with a bit set where the terms that have it outweigh the others; 0 without terms."""
    bits = F.lit(0).cast("long")
    for j in range(32):
        both = F.col(f"v{j}")
        for place, count in ((j, both.bitwiseAND(F.lit((1 << 32) - 1))), (j + 32, F.shiftrightunsigned(both, 32))):
            one = F.lit((1 << place) - (1 << 64) if place == 63 else 1 << place).cast("long")
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("weight"), one).otherwise(F.lit(0).cast("long")))
    return bits


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (together unique) and ``simhash`` of every row."""
    own = docs.select(*[column(docs, k) for k in keys], F.explode_outer(terms_of(column(docs, text))).alias("term"))
    term = F.coalesce("term", F.lit(""))  # no terms: an empty one without weight
    counted = own.groupBy(*[column(own, k) for k in keys]).agg(*votes(term))
    return counted.select(*[column(counted, k) for k in keys], fingerprint_of().alias("simhash"))


def hex_print(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def in_order(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows by descending id, each with a place and its successor's: ``part, sub, at, next_*``.

    The successor of the last row is the first. Null ids come last; rows of equal ids are ordered by a
    hash of their text. Ids are cut at quantiles, and between them evenly, into buckets of about
    ``BUCKET_ROWS`` rows, an id that fills more than a quantile by the hash of its texts; a window finds
    successors inside a bucket, and a join of last and first rows those across. Whole texts are shuffled once.
    """
    own = docs.select(column(docs, id_column).cast("long").alias("id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    known = own.where("id is not null")
    asked = F.percentile_approx("id", [i / QUANTILES for i in range(1, QUANTILES)], 10_000)
    row = known.agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), asked.alias("cuts")).first()
    given = row["cuts"] or []
    hot = sorted({a for a, b in zip(given, given[1:]) if a == b and a < (1 << 63) - 1})  # each between cuts of its own
    cuts = sorted({*given, *[h + 1 for h in hot], *([row["lo"], row["hi"]] if row["n"] else [0])})
    per = max(1, -(-row["n"] // (len(cuts) * BUCKET_ROWS)))  # buckets between two cuts
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    placed = own.withColumn("below", F.size(F.filter(bounds, lambda c: c <= F.col("id"))))  # 1 .. len(cuts)
    placed = placed.withColumns({
        "low": F.element_at(bounds, F.greatest("below", F.lit(1))),
        "high": F.element_at(bounds, F.least(F.col("below") + 1, F.lit(len(cuts)))),
        "tie": F.shiftrightunsigned(F.xxhash64("text"), 1),
        "part": F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(len(cuts) - F.col("below")).cast("int")})
    # doubles round the same way for equal ids and keep their order; a bucket is only a bucket
    share = (F.col("id").cast("double") - F.col("low")) / F.greatest(F.col("high").cast("double") - F.col("low"), F.lit(1.0))
    inside = F.least(F.floor(share * per), F.lit(per - 1)).cast("long")
    by_text = F.col("id").isNull() | F.col("id").isin(hot)
    placed = placed.withColumn("sub", F.when(by_text, F.shiftright("tie", 48)).otherwise(per - 1 - inside).cast("long"))
    placed = placed.select("part", "sub", "id", "tie", "text")
    order = Window.partitionBy("part", "sub").orderBy(F.col("id").desc_nulls_last(), "tie")
    rows = placed.select(
        "part", "sub", F.row_number().over(order).alias("at"), "id", "text",
        F.lead("text").over(order).alias("next_text"))
    inner = rows.where("next_text is not null").select(
        "*", F.col("part").alias("next_part"), F.col("sub").alias("next_sub"), (F.col("at") + 1).alias("next_at"))
    last = rows.where("next_text is null").drop("next_text")
    first = rows.where("at = 1").select(F.col("part").alias("next_part"), F.col("sub").alias("next_sub"), F.col("text").alias("next_text"))
    # successors of buckets: inside a part by a window, across parts by one of a row per part, round to the first
    buckets = placed.select("part", "sub").distinct()
    parts = buckets.groupBy("part").agg(F.min("sub").alias("sub"))
    ring = Window.orderBy("part")
    start = F.first(F.struct("part", "sub")).over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    across = parts.select("part", F.coalesce(F.lead(F.struct("part", "sub")).over(ring), start).alias("then"))
    follow = buckets.select("part", "sub", F.lead("sub").over(Window.partitionBy("part").orderBy("sub")).alias("inner_sub"))
    follow = follow.join(across, "part").select(
        "part", "sub", F.when(F.col("inner_sub").isNull(), F.col("then.part")).otherwise(F.col("part")).alias("next_part"),
        F.coalesce("inner_sub", "then.sub").alias("next_sub"))
    outer = last.join(follow, ["part", "sub"]).join(first, ["next_part", "next_sub"])
    columns = ["part", "sub", "at", "id", "text", "next_part", "next_sub", "next_at", "next_text"]
    return inner.select(columns).unionAll(outer.withColumn("next_at", F.lit(1)).select(columns))


def edited_text(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by as many first ones of ``following``, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compare_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = 3) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document, and how alike they are.

    ``doc_id, n_chars, edited_sha256, simhash, edited_simhash, near_edited, near_next, n_within``. The last is a
    search of the rows whose id is divisible by 20 against all rows: how many other fingerprints, each counted once,
    differ from the row's in ``radius`` bits or fewer; null in rows that do not ask. A null text is
    empty; repeated rows are rows of their own; a single row is its own successor; no rows, no result.
    """
    rows = in_order(docs, id_column, text)
    rows = rows.select(
        "part", "sub", "at", "id", "next_part", "next_sub", "next_at", "text",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    whole, other = terms_of(F.col("text")), terms_of(F.col("edited"))
    # values of a row are made before its terms are spread, or they would be made for every term
    rows = rows.select(
        "part", "sub", "at", "id", "next_part", "next_sub", "next_at", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), whole.alias("whole"), other.alias("other"))
    rows = rows.select(
        "part", "sub", "at", "id", "next_part", "next_sub", "next_at", "n_chars", "edited_sha256",
        F.size("whole").alias("own"), F.concat("whole", F.array(F.lit("")), "other").alias("terms"))  # the gap weighs nothing
    marked = rows.select("*", F.posexplode("terms").alias("i", "term")).drop("terms")
    kept = ["part", "sub", "at", "id", "next_part", "next_sub", "next_at", "n_chars", "edited_sha256"]
    counted = marked.groupBy(*kept, (F.col("i") > F.col("own")).alias("after")).agg(*votes(F.col("term")))
    prints = counted.select(*kept, "after", fingerprint_of().alias("print"))
    pairs = prints.groupBy(*kept).agg(
        F.max(F.when(~F.col("after"), F.col("print"))).alias("simhash"),
        F.coalesce(F.max(F.when(F.col("after"), F.col("print"))), F.lit(0).cast("long")).alias("edited_simhash"))
    pairs = write_and_read(pairs, "prints")
    following = pairs.select(F.col("part").alias("next_part"), F.col("sub").alias("next_sub"),
                             F.col("at").alias("next_at"), F.col("simhash").alias("next_simhash"))
    both = pairs.join(following, ["next_part", "next_sub", "next_at"])
    asks = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    found = both.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "simhash", "edited_simhash",
        likeness(F.col("simhash"), F.col("edited_simhash")).alias("near_edited"),
        likeness(F.col("simhash"), F.col("next_simhash")).alias("near_next"))
    wanted = pairs.where(F.col("id") % 20 == 0).select("simhash")
    within = within_radius(pairs.select("simhash"), wanted, radius).where("distance > 0")
    counted = within.groupBy(F.col("query").alias("simhash")).agg(F.count("*").alias("n_within"))
    told = found.where(asks).join(counted.hint("merge"), "simhash", "left").withColumn("n_within", F.coalesce("n_within", F.lit(0).cast("long")))
    return told.select(*found.columns, "n_within").unionAll(
        found.where(~asks).withColumn("n_within", F.lit(None).cast("long")))


def blocks_for(radius: int, rows: int) -> int:
    """Blocks of 64 bits: as many as keep tables few while a key leaves about one row by chance."""
    best = radius + 1
    for blocks in range(radius + 1, radius + 5):
        kept = 64 * (blocks - radius) // blocks
        if comb(blocks, radius) <= 64 and rows >> min(kept, 62):
            best = blocks
    return best + 1 if comb(best + 1, radius) <= 64 else best


def within_radius(stored: DataFrame, asked: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """``(query, found, distance)`` for distinct fingerprints at ``radius`` or less of each other.

    Both inputs have one column of signed longs. The bits are cut into ``blocks`` > ``radius``; for every choice of
    blocks - radius blocks there is a table keyed by them (the permuted tables: the chosen blocks
    in front), and two fingerprints within the radius agree on at least one choice; the first such table
    gives the pair. Repeats and nulls are left out; nothing is capped, so a crowd of fingerprints near each other
    gives a row for each query in it and each member.
    """
    known = stored.select(F.col(stored.columns[0]).alias("found")).where("found is not null").distinct()
    wanted = asked.select(F.col(asked.columns[0]).alias("query")).where("query is not null").distinct()
    blocks = blocks or blocks_for(radius, known.count())
    if blocks <= radius:
        raise ValueError("there must be more blocks than bits that may differ")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    def tables(value: Column) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(i).alias("t"), value.bitwiseAND(F.lit(m).cast("long")).alias("k")) for i, m in enumerate(masks)]))
    index, probes = known.select("found", tables(F.col("found"))), wanted.select("query", tables(F.col("query")))
    differing = F.col("query").bitwiseXOR(F.col("found"))
    first = F.lit(len(masks))
    for i, m in reversed(list(enumerate(masks))):
        first = F.when(differing.bitwiseAND(F.lit(m).cast("long")) == 0, i).otherwise(first)
    met = (index["t"] == probes["t"]) & (index["k"] == probes["k"]) & (F.bit_count(differing) <= radius) & (probes["t"] == first)
    return probes.join(index.hint("merge"), met).select("query", "found", F.bit_count(differing).alias("distance"))
