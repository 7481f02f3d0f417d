"""Benchmark decontamination by greedy string tiling.

A benchmark item is found in a document if tiles cover enough of it: tiles are matches of at least
``min_match`` words, marked longest first, that overlap neither in the item nor in the document, so a
passage counts whatever the order of its parts. Candidates come from a join on hashed seeds of
``min_match`` words. A tile of n words holds n - min_match + 1 seeds, so the words of an item under
shared seeds bound its tiles, and a pair under the threshold by that bound is never tiled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import column, slices, write_and_read
from foliary.session import ship_package

BASE = 0x9E3779B97F4A7C15
WORDS_AT_ONCE = 200_000
FILTER_BITS = (16, 27)
#: Lower-cased ASCII letters and digits and all bytes of other characters make words.
LETTERS = bytes.maketrans(bytes(range(128)), bytes(c if chr(c).isalnum() else 32 for c in range(128)))


@dataclass(frozen=True)
class Settings:
    min_match: int = 5
    threshold: float = 0.8


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit polynomial hash of each word."""
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    powers = np.full(int(sizes.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    value = np.add.reduceat(data * powers[place], starts)
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` values, through running sums of powers."""
    n = len(values)
    if n < size or size < 1:
        return np.zeros(0, np.uint64)
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * np.multiply.accumulate(up))])
    found = (sums[size:] - sums[:-size]) * np.multiply.accumulate(down)[:n - size + 1]
    return found ^ (found >> np.uint64(32))


def tiles(item: list[bytes], text: list[bytes], min_match: int = 5) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of greedy tiles, longest first; ties by place.

    The window shrinks by halves from the item's length. All matches of at least a window's length lie
    on diagonals of equal windows, so each step marks every tile of that length or more.
    """
    least = min(min_match, len(item))
    if not least or len(text) < least:
        return []
    known: dict = {}
    a = np.array([known.setdefault(w, len(known) + 1) for w in item], np.uint64)
    b = np.array([known.get(w, 0) for w in text], np.uint64)
    free_a, free_b = np.ones(len(a), bool), b != 0
    found, size = [], max(least, min(len(a), len(b)))
    while True:
        for match in _matches(a, b, free_a, free_b, size):
            found.append(match)
        if size == least:
            return found
        size = max(least, size // 2)


def _open_windows(free: np.ndarray, size: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[size:] == taken[:-size])


def _matches(a, b, free_a, free_b, size) -> Iterator[tuple[int, int, int]]:
    """Mark and yield the matches of ``size`` words or more, longest first."""
    if len(b) < size or len(a) < size:
        return
    at_a, at_b = _open_windows(free_a, size), _open_windows(free_b, size)
    if not len(at_a) or not len(at_b):
        return
    hash_a, hash_b = window_hashes(a, size)[at_a], window_hashes(b, size)[at_b]
    hit = np.isin(hash_b, hash_a)
    at_b, hash_b = at_b[hit], hash_b[hit]
    order = np.argsort(hash_a, kind="stable")
    lo = np.searchsorted(hash_a[order], hash_b, side="left")
    times = np.searchsorted(hash_a[order], hash_b, side="right") - lo
    p = at_a[order[np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())]]
    t = np.repeat(at_b, times)
    same = np.ones(len(p), bool)
    for j in range(size):  # equal hashes are checked word by word
        same &= a[p + j] == b[t + j]
    p, t = p[same], t[same]
    if not len(p):
        return
    order = np.lexsort((p, t - p))
    p, t = p[order], t[order]
    fresh = np.concatenate([[True], (np.diff(t - p) != 0) | (np.diff(p) != 1)])
    starts = np.flatnonzero(fresh)
    runs = np.diff(np.append(starts, len(p))) + size - 1
    heap = [(-int(n), int(p[s]), int(t[s])) for s, n in zip(starts, runs, strict=True)]
    heapify(heap)
    while heap:
        n, i, j = heappop(heap)
        n = -n
        ok = free_a[i:i + n] & free_b[j:j + n]
        if ok.all():
            free_a[i:i + n] = False
            free_b[j:j + n] = False
            yield i, j, n
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # what is left of it
            if y - x >= size:
                heappush(heap, (-(y - x), i + x, j + x))


def seeds_of(words: list[bytes], size: int) -> np.ndarray:
    return window_hashes(word_hashes(words), size) + np.uint64(size)


def _seed_table(items: DataFrame, s: Settings, item_id: str, text: str) -> DataFrame:
    """``(item, n_words, place, size, seed)`` for every seed of every item that has words.

    An item shorter than ``min_match`` words is one seed.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 256, 1_000_000):
                out: dict = {"item": [], "n_words": [], "place": [], "size": [], "seed": []}
                for item, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = words_of(body)
                    size = min(s.min_match, len(words))
                    values = _row_seeds(words, size) if size else []
                    out["item"] += [item] * len(values)
                    out["n_words"] += [len(words)] * len(values)
                    out["place"] += range(len(values))
                    out["size"] += [size] * len(values)
                    out["seed"] += values
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("item", pa.int64()), ("n_words", pa.int32()), ("place", pa.int32()), ("size", pa.int32()),
                    ("seed", pa.int64())]))

    chosen = items.select(column(items, item_id).cast("long").alias("item"), column(items, text).alias("body"))
    return chosen.mapInArrow(make, "item long, n_words int, place int, size int, seed long")


def _row_seeds(words: list[bytes], size: int) -> list[int]:
    """Seeds of one text as signed longs, computed a bounded number of words at a time."""
    out: list[int] = []
    for lo in range(0, max(1, len(words) - size + 1), WORDS_AT_ONCE):
        out += seeds_of(words[lo:lo + WORDS_AT_ONCE + size - 1], size).view(np.int64).tolist()
    return out


def _filter(spark: SparkSession, seeds: DataFrame) -> tuple[int, np.ndarray]:
    """A bitmap with two places per seed, at most 16 MB whatever the number of seeds.

    It only spares the join below: 2^16 bits a seed, where they fit, let a few windows in a thousand million pass.
    """
    count = seeds.count()
    bits = min(max(int(count << 16).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    places = [F.shiftrightunsigned("seed", 64 - bits), F.col("seed").bitwiseAND(F.lit((1 << bits) - 1))]
    spread = seeds.select(F.explode(F.array(*places)).alias("place"))
    words = spread.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))).alias("bits")).collect()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    for r in words:
        bitmap[r["word"]] = np.uint64(r["bits"] & ((1 << 64) - 1))
    return bits, bitmap


def _hit_documents(docs: DataFrame, seeds: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(row, id, body, seeds)``: documents with seeds that pass the filter; ``seeds`` without repeats."""
    spark = docs.sparkSession
    bits, bitmap = _filter(spark, seeds)
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # at most min_match
    shipped = spark.sparkContext.broadcast(bitmap)
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), column(docs, id_column).alias("id"), column(docs, text).alias("body"))
    schema = T.StructType([*own.schema.fields, T.StructField("seeds", T.ArrayType(T.LongType()))])

    def passing(words: list[bytes], owner: np.ndarray, found: dict[int, set]) -> None:
        values = word_hashes(words)
        for size in sizes:
            hashes = window_hashes(values, size) + np.uint64(size)
            if not len(hashes):
                continue
            at = np.flatnonzero(owner[:len(hashes)] == owner[size - 1:])
            for place in (hashes >> np.uint64(64 - bits), hashes & np.uint64((1 << bits) - 1)):
                place = place[at]
                at = at[shipped.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) != 0]
            for i, seed in zip(owner[at].tolist(), hashes[at].view(np.int64).tolist(), strict=True):
                found.setdefault(i, set()).add(seed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        overlap = max(sizes, default=1) - 1
        for batch in batches:
            for part in slices(batch, 2, 2048, 2_000_000):
                words: list[bytes] = []
                counts = []
                for body in part.column(2).to_pylist():
                    own_words = words_of(body)
                    counts.append(len(own_words))
                    words += own_words
                owner = np.repeat(np.arange(len(counts)), counts)
                found: dict[int, set] = {}
                for lo in range(0, len(words), WORDS_AT_ONCE):
                    hi = lo + WORDS_AT_ONCE + overlap
                    passing(words[lo:hi], owner[lo:hi], found)
                keep = sorted(found)
                rows = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([sorted(found[i]) for i in keep], pa.list_(pa.int64()))],
                    names=["row", "id", "body", "seeds"])

    return own.mapInArrow(scan, schema)


def find_items(
    docs: DataFrame, items: DataFrame, s: Settings | None = None, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(row, id, item, coverage, tiles)`` for every document and item covered to the threshold or more.

    ``row`` numbers the rows of ``docs`` as they are read, so repeated rows and null ids stay apart;
    ``tiles`` are (item_start, doc_start, words) in words. ``items`` may have repeated ids; each row
    counts as a text of its own under its id and the best coverage is returned. Null and wordless texts
    match nothing. Empty tables give no rows.
    """
    s = s or Settings()
    spark = docs.sparkSession
    ship_package(spark)
    own = items.select(column(items, item_id).alias("name"), column(items, item_text).alias("body"))
    named = write_and_read(own.withColumn("item", F.monotonically_increasing_id()), "benchmark")
    seeds = write_and_read(_seed_table(named, s, "item", "body"), "seeds")
    hits = write_and_read(_hit_documents(docs, seeds, id_column, text), "hits")
    # words of the item under shared seeds: places start .. start + size - 1, of bounded number per item
    met = hits.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select(
        "row", "item", "n_words", "place", "size")
    bound = met.groupBy("row", "item").agg(
        F.max("n_words").alias("n_words"), F.max("size").alias("size"), F.array_sort(F.collect_set("place")).alias("places"))
    covered = F.expr("""
        aggregate(zip_with(places, slice(places, 2, size(places)), (p, q) -> least(size, coalesce(q - p, size))), 0, (n, x) -> n + x)
    """.replace("size(places)", "cardinality(places)"))
    pairs = bound.where(covered >= s.threshold * F.col("n_words")).select("row", "item")
    texts = pairs.join(hits.select("row", "id", "body"), "row").join(
        named.select("item", "name", F.col("body").alias("item_body")), "item")
    texts = texts.select("row", "id", "name", "body", "item_body")
    schema = T.StructType([
        *texts.schema.fields[:3], T.StructField("coverage", T.DoubleType()),
        T.StructField("tiles", T.ArrayType(T.StructType([
            T.StructField("item_start", T.IntegerType()), T.StructField("doc_start", T.IntegerType()),
            T.StructField("words", T.IntegerType())])))])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, 3, 512, 2_000_000):
                out = []
                for row in part.to_pylist():
                    item = words_of(row["item_body"])
                    found = tiles(item, words_of(row["body"]), s.min_match)
                    coverage = sum(n for _, _, n in found) / len(item)
                    if coverage >= s.threshold:
                        out.append({
                            "row": row["row"], "id": row["id"], "name": row["name"], "coverage": coverage,
                            "tiles": [{"item_start": i, "doc_start": j, "words": n} for i, j, n in found]})
                yield pa.RecordBatch.from_pylist(out, schema=target)

    found = texts.mapInArrow(tile, schema)
    best = found.groupBy("row", "name").agg(
        F.first("id").alias("id"), F.max_by(F.struct("coverage", "tiles"), "coverage").alias("best"))
    return best.select("row", "id", F.col("name").alias("item"), "best.coverage", "best.tiles")


def contaminated(docs: DataFrame, items: DataFrame, s: Settings | None = None, **columns) -> DataFrame:
    """One row per contaminated document: its id, the items found in it and the highest coverage."""
    found = find_items(docs, items, s, **columns)
    per = found.groupBy("row").agg(
        F.first("id").alias("doc_id"), F.array_sort(F.collect_set("item")).alias("item_ids"),
        F.max_by("item", F.struct("coverage", F.col("item"))).alias("item_id"), F.max("coverage").alias("coverage"),
        F.sum(F.size("tiles")).alias("n_tiles"))
    return per.drop("row")


def keep_clean(docs: DataFrame, items: DataFrame, s: Settings | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) in which no item is found.

    Rows are numbered as they are read; ``docs`` is written first so that the numbers hold.
    """
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    numbered = docs.select(*[column(docs, c).alias(n) for c, n in names.items()])
    numbered = write_and_read(numbered.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = find_items(numbered, items, s, id_column="__row", text=names[text])
    rows = write_and_read(found.select(F.col("id").alias("__row")).distinct(), "found")
    clean = numbered.join(rows, "__row", "left_anti")
    return clean.select(*[F.col(n).alias(c) for c, n in names.items()])
