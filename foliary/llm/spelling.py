"""Spelling variants: words of a corpus that are one insertion, deletion or replacement apart.

Two near words of L letters or one more share their first or their last ceil((L - 1) / 2) letters, so the sorted list of
words and the sorted list of reversed words hold every near word of a word in one short range of one of
them. The lists are cut into blocks at words picked by their hash; a word asks the blocks its range reaches.
In a block, the range is scanned in order: the rows of the banded edit matrix of a listed word are kept for
the prefix the next one shares with it, and where a row has no entry under two, all words with that prefix
are skipped.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.frames import column, slices, write_and_read
from foliary.session import cut, ship_package

RUN = re.compile("[A-Za-zÀ-ÿ]+")
TOP = "\U0010ffff"
#: One word in so many ends a block, or fewer where that would make more than ``MOST_BLOCKS`` of them.
BLOCK_WORDS = 2048
MOST_BLOCKS = 20_000
#: Words that ask one copy of a block, about.
ASKING = 8192
COUNTED_AT_ONCE = 400_000


# --- words -------------------------------------------------------------------------------------

def runs_of(text: str | None) -> list[str]:
    """Runs of letters, A-Z as a-z."""
    return RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else []


def typo(doc_id, run: str, every: int = 97) -> str:
    """The run as document ``doc_id`` spells it: one in ``every`` pairs of id and run loses a letter."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3,
    spelled: Callable[[object, str], str] | None = None,
) -> DataFrame:
    """``(word, n)`` of words of ``min_length`` letters or more that occur ``min_count`` times or more.

    ``spelled(doc_id, run)`` may change a run (never lengthen it); runs are taken as they are by default. Null texts
    have no words; repeated rows count again. Words are counted in the tasks before they are shuffled.
    """
    ship_package(docs.sparkSession)

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 1, 2048, 4_000_000):
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if spelled is None:
                        counts.update([w for w in runs_of(body) if len(w) >= min_length])
                        continue
                    for run, n in Counter(runs_of(body)).items():
                        if len(run) >= min_length:
                            word = spelled(doc_id, run)
                            if len(word) >= min_length:
                                counts[word] += n
                    if len(counts) > COUNTED_AT_ONCE:
                        yield table(counts)
                        counts = Counter()
        if counts:
            yield table(counts)

    rows = docs.select(column(docs, id_column).alias("id"), column(docs, text).alias("text")).mapInArrow(
        counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- near words --------------------------------------------------------------------------------

def shared_letters(word: str) -> int:
    """So many first, or so many last letters does a word share with each near word."""
    return len(word) // 2


def near_in(listed: list[str], shared: list[int], word: str) -> list[int]:
    """Places of the words in a sorted list that are one edit from ``word`` and share its first letters.

    ``shared[i]`` is the length of the common prefix of the words i and i - 1. Row d of the matrix holds the distances
    of a listed word's first d letters to the first d - 1, d and d + 1 letters of ``word``; 2 stands for more.
    """
    size, k = len(word), shared_letters(word)
    i, count = bisect_left(listed, word[:k]), len(listed)
    if i == count or not listed[i].startswith(word[:k]):
        return []
    found = []
    rows = [(2, 2, 2)] * (size + 3)
    rows[k] = (1, 0, 1 if k < size else 2)
    q = word + "\0\0\0"
    depth = k
    while True:
        other = listed[i]
        length = len(other)
        if length > size + 1:
            end = size + 1
        else:
            end = length
        a, b, c = rows[depth]
        dead = False
        while depth < end:
            letter = other[depth]
            depth += 1
            # three cells of row ``depth``, each from the cells before, above and beside it
            a = a if q[depth - 2] == letter else a + 1
            if b < a:
                a = b + 1 if b + 1 < a else a
            same = b if depth <= size and q[depth - 1] == letter else b + 1
            if c + 1 < same:
                same = c + 1
            if a + 1 < same:
                same = a + 1
            more = c if depth < size and q[depth] == letter else c + 1
            if same + 1 < more:
                more = same + 1
            if depth > size:
                same = more = 2
            elif depth == size:
                more = 2
            b, c = same, more
            if a > 1 and b > 1 and c > 1:
                dead = True
                break
            rows[depth] = (a, b, c)
        if dead or length > end:
            cut_at = depth if dead else end + 1
            kept = cut_at - 1
            i += 1
            steps = 0
            while i < count and shared[i] >= cut_at:
                i += 1
                steps += 1
                if steps == 8:
                    i = bisect_left(listed, other[:cut_at] + TOP, i)
                    break
        else:
            distance = (b if length == size else a if length == size + 1 else c if length == size - 1 else 2)
            if distance == 1:
                found.append(i)
            kept = length
            i += 1
        if i >= count or shared[i] < k:
            return found
        depth = shared[i] if shared[i] < kept else kept


def common_prefixes(words: list[str]) -> list[int]:
    out = [0]
    for x, y in zip(words, words[1:]):
        n, most = 0, min(len(x), len(y))
        while n < most and x[n] == y[n]:
            n += 1
        out.append(n)
    return out


def _routed(words: DataFrame, bounds: list[list[str]]) -> DataFrame:
    """``(lane, block, asks, key, n)``: each word listed in its block and asking the blocks its range reaches."""
    shared = words.sparkSession.sparkContext.broadcast(bounds)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes, blocks, asks, keys, counts = [], [], [], [], []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for lane, key in enumerate((word, word[::-1])):
                    ends = shared.value[lane]
                    prefix = key[:shared_letters(key)]
                    reached = range(bisect_right(ends, prefix), bisect_left(ends, prefix + TOP) + 1)
                    blocks += [bisect_right(ends, key), *reached]
                    asks += [0] + [1] * len(reached)
                    lanes += [lane] * (len(reached) + 1)
                    keys += [key] * (len(reached) + 1)
                    counts += [n] * (len(reached) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lanes, pa.int32()), pa.array(blocks, pa.int32()), pa.array(asks, pa.int32()),
                 pa.array(keys, pa.string()), pa.array(counts, pa.int64())], names=["lane", "block", "asks", "key", "n"])

    return words.select("word", "n").mapInArrow(passed, "lane int, block int, asks int, key string, n long")


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by block, listed words first: the listed words are held, the others pass."""
    here, listed, counts, shared = None, [], [], None
    for batch in batches:
        out: list[tuple] = []
        for lane, block, copy, asks, key, n in zip(*[c.to_pylist() for c in batch.columns]):
            if (lane, block, copy) != here:
                here, listed, counts, shared = (lane, block, copy), [], [], None
            if not asks:
                listed.append(key)
                counts.append(n)
                continue
            if shared is None:
                shared = common_prefixes(listed)
            places = near_in(listed, shared, key)
            if lane and places:  # what the first letters find is found in the other list
                tail = key[len(key) - shared_letters(key):]
                places = [p for p in places if not listed[p].endswith(tail)]
            if places:
                best = max(counts[p] for p in places)
                names = [listed[p][::-1] if lane else listed[p] for p in places if counts[p] == best]
                out.append((key[::-1] if lane else key, len(places), best, min(names)))
        columns = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["word", "n_near", "near_n", "near"])


def nearest(words: DataFrame) -> DataFrame:
    """``(word, n_near, near, near_n)`` of the words of ``(word, n)`` that have near words.

    ``near`` is the near word of the largest n, of several the first in code-point order. ``words``: distinct words of two
    letters or more, read several times. A block that many words ask is copied, so no task holds more than a block of
    words and a bounded number of asking ones; blocks end at words picked by a hash, at most ``MOST_BLOCKS`` of them.
    """
    spark = words.sparkSession
    ship_package(spark)
    total = words.count()
    every = max(BLOCK_WORDS, -(-total // MOST_BLOCKS))
    picked = [r[0] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect()]
    rows = write_and_read(_routed(words, [sorted(picked), sorted(w[::-1] for w in picked)]), "asking")
    crowds = rows.where("asks = 1").groupBy("lane", "block").count()
    copies = crowds.select("lane", "block", F.ceil(F.col("count") / ASKING).cast("int").alias("copies"))
    rows = rows.join(F.broadcast(copies), ["lane", "block"])  # at most two rows a block; a block nobody asks goes
    copy = F.when(F.col("asks") == 1, F.array(F.pmod(F.xxhash64("key"), F.col("copies")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("copies") - 1))
    rows = rows.select("lane", "block", F.explode(copy).alias("copy"), "asks", "key", "n")
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(max(at_least, total // 8192), "lane", "block", "copy")
    found = dealt.sortWithinPartitions("lane", "block", "copy", "asks", "key").mapInArrow(
        _scanned, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the end of the chain of forms that starts at each word.

    Chains must end. Each round doubles the stretch a word has gone, so rounds grow with the logarithm of the longest
    chain; a form that many words share meets them in a merge join.
    """
    gone = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = gone.select(F.col("word").alias("root"), F.col("root").alias("__next")).hint("merge")
        step = cut(gone.join(further, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")))
        gone = step.select("word", "root")
        if step.where("moved").isEmpty():
            return gone


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """``words`` (word, n) with ``n_near``, ``form``, ``form_n`` and ``root``.

    The form of a word is its near word of the largest n if that is ``times`` its own n or more; ``root`` is where its
    forms lead, itself without one. An empty table gives an empty one.
    """
    words = write_and_read(words.select("word", "n"), "words")
    far = words.join(nearest(words), "word", "left")
    is_form = F.col("near_n") >= times * F.col("n")
    held = write_and_read(far.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(held.where("form is not null").select("word", "form"))
    return held.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
