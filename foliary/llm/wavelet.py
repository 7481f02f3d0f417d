"""Token shards as wavelet matrices.

A shard is one Parquet file with one row: the documents' ids and token counts, and one bit-plane per
bit of the vocabulary. Plane 0 holds the highest bit of every token in order; each further plane
holds the next bit after a stable partition by the bit before (zeros first). With the number of set
bits before every block of 512, ``rank`` and ``select`` take a block lookup and one popcount, so a
token, the number of times it occurs, and the places where it occurs come from the planes alone.

Documents with a null text count as empty and hold the end id only; a null ``doc_id`` sorts first;
repeated rows are stored as often as they occur. No documents, no files.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import held, new_folder, slices
from foliary.llm.words import ENDS, GAP, LONGEST_CACHED, MARKS, ColumnIds
from foliary.session import ship_package

BLOCK_BITS = 512
SHARD_TOKENS = 1 << 21
END_ID = 0
#: Letters that stay one piece next to each other, and words of them.
LETTERS = "".join(sorted(c for c in ENDS if "9" < c < "\u0500"))
LETTERED = re.compile(f"[{LETTERS}]+").fullmatch
#: Byte-level vocabularies write the bytes without a printable sign as U+0100 and up, in order.
BYTE_SIGNS = {b: chr(0x100 + 33 + i) for i, b in enumerate([*range(0x7F, 0xA1), 0xAD])}
LETTER_SIGNS = {c: c.encode().decode("latin-1").translate(BYTE_SIGNS) for c in LETTERS}
SPACE_SIGN = "\u0120"

FILE_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_tokens", T.ArrayType(T.LongType())),
    T.StructField("zeros", T.ArrayType(T.LongType())), T.StructField("planes", T.ArrayType(T.BinaryType())),
    T.StructField("ranks", T.ArrayType(T.BinaryType())),
])


class WaveletMatrix:
    """Bit-planes over ``n`` ids with rank and select."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks
        self.bits = [np.frombuffer(p, np.uint8) for p in planes]
        self.before = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        """``levels`` bits per id; by default as many as the largest id needs."""
        if levels is None:
            levels = max(1, int(ids.max(initial=0)).bit_length())
        row = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for level in range(levels - 1, -1, -1):
            bit = (row >> row.dtype.type(level)) & row.dtype.type(1) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(packed.tobytes())
            ranks.append(block_ranks(packed).tobytes())
            low, high = row[np.flatnonzero(~bit)], row[np.flatnonzero(bit)]  # places are faster than masks
            zeros.append(len(low))
            row = np.concatenate([low, high])
        return cls(len(ids), zeros, planes, ranks)

    def ones_before(self, level: int, i: int) -> int:
        """Set bits of a plane before position ``i``."""
        block, bits = i // BLOCK_BITS, self.bits[level]
        start = block * (BLOCK_BITS // 8)
        whole = int(np.bitwise_count(bits[start:i // 8]).sum())
        rest = int(bits[i // 8] & ((1 << (i % 8)) - 1)).bit_count() if i % 8 else 0
        return int(self.before[level][block]) + whole + rest

    def _select(self, level: int, k: int, one: bool) -> int:
        """Position of the ``k``-th (from 0) bit of a kind."""
        before = self.before[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        start = block * (BLOCK_BITS // 8)
        bits = np.unpackbits(self.bits[level][start:start + BLOCK_BITS // 8], bitorder="little")
        bits = bits[:self.n - block * BLOCK_BITS]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == int(one))[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, zeros in enumerate(self.zeros):
            one = self.bits[level][i // 8] >> (i % 8) & 1
            ones = self.ones_before(level, i)
            value = value << 1 | int(one)
            i = zeros + ones if one else i - ones
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``symbol`` before ``end`` lie below the last plane."""
        if symbol >> len(self.zeros):
            return 0, 0
        lo, hi = 0, end
        for level, zeros in enumerate(self.zeros):
            a, b = self.ones_before(level, lo), self.ones_before(level, hi)
            if symbol >> (len(self.zeros) - 1 - level) & 1:
                lo, hi = zeros + a, zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs before position ``end``."""
        lo, hi = self._range(symbol, end)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Position of occurrence ``k`` (from 0) of ``symbol``."""
        lo, hi = self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(len(self.zeros) - 1, -1, -1):
            if symbol >> (len(self.zeros) - 1 - level) & 1:
                i = self._select(level, i - self.zeros[level], True)
            else:
                i = self._select(level, i, False)
        return i

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def ids(self) -> np.ndarray:
        """All ids in order: the planes' partitions undone from the last to the first."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        row = np.zeros(self.n, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.bits[level], count=self.n, bitorder="little").view(bool)
            back, zeros = np.empty(self.n, kind), self.zeros[level]
            back[np.flatnonzero(~bit)] = row[:zeros]
            back[np.flatnonzero(bit)] = row[zeros:] | kind(1 << (len(self.zeros) - 1 - level))
            row = back
        return row.astype(np.uint32)


def block_ranks(packed: np.ndarray) -> np.ndarray:
    """Set bits before every block of 512, and before the end."""
    counts = np.bitwise_count(packed).astype(np.uint32)
    size = BLOCK_BITS // 8
    sums = np.add.reduceat(counts, np.arange(0, len(counts), size)) if len(counts) else counts
    return np.concatenate([[0], np.cumsum(sums)]).astype("<u4")


def signs(letters: str) -> str:
    """The signs of a byte-level vocabulary for the UTF-8 bytes of letters."""
    return letters if letters.isascii() else "".join(map(LETTER_SIGNS.__getitem__, letters))


def byte_pair_ids(model: bytes) -> ColumnIds:
    """A tokenizer of the ``tokenizers`` library behind a cache of words."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    tokenizer = Tokenizer.from_buffer(model)

    def encode(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    before = tokenizer.pre_tokenizer
    pieces = [p for p, _ in before.pre_tokenize_str(" " + LETTERS)] if before and not tokenizer.normalizer else []
    by_letters = (
        pieces == [SPACE_SIGN + signs(LETTERS)] and isinstance(tokenizer.model, BPE)
        and all(set(t) - set(" " + LETTERS) for t in added))

    def lettered(words: list[str], space: str, others: Callable) -> list[bytes]:
        """Short words of letters are one piece to the tokenizer, so its model is asked at once; the rest as before."""
        plain = [
            by_letters and w.isalpha() and len(w) <= LONGEST_CACHED and (w.isascii() or LETTERED(w) is not None)
            for w in words]
        rest = [w for w, p in zip(words, plain, strict=True) if not p]
        made = iter(others(rest) if rest else [])
        if len(rest) == len(words):
            return list(made)
        merge = tokenizer.model.tokenize
        ids: list[int] = []
        stops = []
        for word in compress(words, plain):
            ids += [token.id for token in merge(space + signs(word))]
            stops.append(len(ids) * 4)
        raw = np.array(ids, "<u4").tobytes()
        cut = iter([raw[x:y] for x, y in zip([0, *stops[:-1]], stops, strict=True)])
        return [next(cut if p else made) for p in plain]

    # a token of a byte-level vocabulary has a letter per byte; added tokens stand for themselves
    size = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        size[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        size[i] = len(token.content.encode())

    def tails(words: list[str]) -> list[bytes]:
        """All words at once as one text, cut at the words' last bytes."""
        ids = np.array(tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        reached = np.cumsum(size[ids])
        cut = np.searchsorted(reached, ends)
        if not np.array_equal(reached[np.minimum(cut, len(ids) - 1)], ends):  # tokens of another kind
            return encode([" " + w for w in words])
        raw, stops = ids.tobytes(), ((cut + 1) * 4).tolist()
        return [raw[x:y] for x, y in zip([0, *stops[:-1]], stops, strict=True)]

    def whole(text: str) -> bytes:
        return b"".join(encode(GAP.split(text)))

    # parts of words are encoded apart only if the tokenizer itself cuts there
    probe = before.pre_tokenize_str("ab1.;\nCd?!\n2,") if before else []
    cuts = {0, *(end for _, (_, end) in probe)} >= {0, 3, 5, 6, 8, 10, 11, 12, 13}
    cuts = cuts and all(before.pre_tokenize_str(c + m)[0][1] == (0, 1) for c in "a1" for m in MARKS)
    held_back = any(c in MARKS + "\n" for t in added for c in t)
    return ColumnIds(
        lambda words: lettered(words, "", encode), lambda words: lettered(words, SPACE_SIGN, tails), whole,
        cuts and not held_back)


def write_shards(
    docs: DataFrame, model: bytes, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
    id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending id order below ``path``.

    ``model`` is a ``tokenizers`` file with a byte-level pre-tokenizer that splits before spaces.
    Equal ids are ordered by a hash of their text. Documents are never split; a shard ends with the document that
    fills it, so a task holds one shard and one slice of texts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(model)
    digest = zlib.crc32(model)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(FILE_SCHEMA)
        coder = held(("byte pairs", digest), lambda: byte_pair_ids(shipped.value))
        part, shard, start, filled = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids: list = []
        values: list[bytes] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(values), "<u4")
            matrix = WaveletMatrix.build(ids)
            row = {
                "part": part, "shard": shard, "part_start": start, "n_tokens": len(ids), "doc_ids": doc_ids,
                "doc_tokens": [len(v) // 4 for v in values], "zeros": matrix.zeros, "planes": matrix.planes,
                "ranks": matrix.ranks,
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for piece in slices(batch, 1, 8192, 8_000_000):
                for doc_id, value in zip(piece.column(0).to_pylist(), coder.values(piece.column(1)), strict=True):
                    doc_ids.append(doc_id)
                    values.append(value + end)
                    filled += len(value) // 4 + 1
                    if filled >= shard_tokens:
                        yield flush()
                        start, shard, filled = start + filled, shard + 1, 0
                        doc_ids, values = [], []
        if doc_ids:
            yield flush()

    ordered = (
        docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
        .withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    )
    (
        ordered.select("id", "text").mapInArrow(encode, FILE_SCHEMA)
        .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)
    )


def shard_matrices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: ``doc_id, start, n_tokens, ids_crc32``, all from the files."""
    ship_package(spark)
    files = shard_matrices(spark, path)
    bases = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))  # one row per written partition
    bases = bases.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("base"))
    fields = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"]).ids()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                raw = memoryview(ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["part_start"], pa.int64()), pa.array(row["doc_tokens"], pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ], names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    return files.mapInArrow(decode, fields).join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_counts(spark: SparkSession, path: str, token_ids: list[int]) -> DataFrame:
    """Per shard, how often each of the given ids occurs: two ranks per plane, no decoding."""
    ship_package(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                matrix = WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ranks"])
                yield pa.RecordBatch.from_pylist([
                    {"part": row["part"], "shard": row["shard"], "token_id": t, "n": matrix.count(t)} for t in token_ids
                ], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("token_id", pa.int64()), ("n", pa.int64())]))

    files = shard_matrices(spark, path).select("part", "shard", "n_tokens", "zeros", "planes", "ranks")
    return files.mapInArrow(count, "part int, shard int, token_id long, n long")


def encode_and_read(docs: DataFrame, model: bytes, **options) -> DataFrame:
    """Write shards into the shared folder and read their documents back."""
    path = new_folder(docs.sparkSession, "wavelet")
    write_shards(docs, model, path, **options)
    return read_documents(docs.sparkSession, path)
