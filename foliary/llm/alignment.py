"""Two tokenizers' tokens of the same bytes: groups, links and how common each linked pair is.

Texts are cut before spaces, where both tokenizers end a token, and each distinct part is encoded once. The
links of a chunk of documents become postings: per pair of ids a compressed bitmap of the chunk's documents, and
bit-planes that tell how often a document holds the pair. Bitmaps of one pair and chunk are merged by OR;
set bits count documents, planes add up to links; and the postings, joined with the counts of their pairs,
return the scores to their documents.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import column, held, slices, without, write_and_read
from foliary.session import ship_package

GAP = re.compile(r"(?<=\S)(?= )")
MARK = "▁"
CHUNK_DOCS = 1 << 16
#: Characters whose links are gathered before they become postings.
GATHERED_CHARS = 12_000_000
CACHED_PARTS, CACHED_CHARS, LONG_PART = 250_000, 12_000_000, 200


# --- compressed bitmaps ------------------------------------------------------------------------

def pack(places: np.ndarray) -> bytes:
    """Sorted distinct places under 65,536 as a list of 16-bit numbers or as bits, whichever is shorter."""
    if not len(places):
        return b""
    size = (int(places[-1]) >> 3) + 1
    if size < 2 * len(places):
        bits = np.zeros(size << 3, np.uint8)
        bits[places] = 1
        return b"\1" + np.packbits(bits, bitorder="little").tobytes()
    return b"\0" + places.astype("<u2").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    if data[0]:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(data, "<u2", offset=1).astype(np.int64)


def popcount(data: bytes) -> int:
    if not data:
        return 0
    return int.from_bytes(data, "little").bit_count() - 1 if data[0] else len(data) >> 1


def merge(parts: list[bytes]) -> bytes:
    """The bitmap of the places in any of ``parts``."""
    whole = np.zeros(CHUNK_DOCS, bool)
    for part in parts:
        whole[unpack(part)] = True
    return pack(np.flatnonzero(whole))


# --- alignment ---------------------------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by letter."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and what they make of parts of texts seen lately.

    ``a`` is a byte-level BPE of the tokenizers library, encoding a space and the text; ``b`` is a SentencePiece model
    that puts the space itself.
    """

    def __init__(self, a: bytes, b: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(letters.get(c, 0) for c in entry)
        self.n_b = self.b.get_piece_size()
        pieces = map(self.b.id_to_piece, range(self.n_b))
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        if len(self.a_bytes) * self.n_b >= 1 << 47:
            raise ValueError("the vocabularies are too large for pairs of 47 bits")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.n_of = [array("i"), array("i"), array("i"), array("i")]  # a, b, groups, links; -1 if the bytes differ
        self.written: list[bytes] = []
        self.pairs, self.first = array("q"), array("q", [0])

    def align(self, a_ids: list[int], b_ids: list[int]) -> tuple[list[str], list[tuple[int, int]]]:
        """Groups as text, and the linked pairs, each as often as it is linked."""
        size_a, size_b = self.a_bytes, self.b_bytes
        groups, links, i, j, first_i, first_j = [], [], 0, 0, 0, 0
        end_a, end_b = len(size_a[a_ids[0]]), len(size_b[b_ids[0]])
        while True:
            links.append((a_ids[i], b_ids[j]))
            if end_a < end_b:
                i += 1
                end_a += len(size_a[a_ids[i]])
            elif end_b < end_a:
                j += 1
                end_b += len(size_b[b_ids[j]])
            else:
                i, j = i + 1, j + 1
                groups.append(",".join(map(str, a_ids[first_i:i])) + "|" + ",".join(map(str, b_ids[first_j:j])))
                if i == len(a_ids):
                    return groups, links
                first_i, first_j = i, j
                end_a += len(size_a[a_ids[i]])
                end_b += len(size_b[b_ids[j]])

    def _learn(self, keys: list[str]) -> None:
        """Encode new parts; a part's key is the part without its leading space."""
        found = self.a.encode_batch_fast([" " + k for k in keys], add_special_tokens=False)
        other = self.b.encode(keys, num_threads=1)
        alone = [self.b.piece_to_id(MARK)]
        for key, a, b_ids in zip(keys, found, other, strict=True):
            a_ids, b_ids = a.ids, b_ids or alone  # the library gives an empty text no space
            self.known[key] = len(self.written)
            self.chars += len(key)
            whole = b" " + key.encode("utf-8", "replace")
            if b"".join([self.a_bytes[i] for i in a_ids]) != whole or b"".join([self.b_bytes[i] for i in b_ids]) != whole:
                counts, text = (-1, -1, -1, -1), b""
            else:
                if len(a_ids) == 1 and len(b_ids) == 1:
                    groups, links = [f"{a_ids[0]}|{b_ids[0]}"], [(a_ids[0], b_ids[0])]
                else:
                    groups, links = self.align(a_ids, b_ids)
                counts, text = (len(a_ids), len(b_ids), len(groups), len(links)), ";".join(groups).encode()
                self.pairs.extend([x * self.n_b + y for x, y in links])
            for into, n in zip(self.n_of, counts):
                into.append(n)
            self.written.append(text)
            self.first.append(len(self.pairs))

    def parts_of(self, text: str) -> list[str]:
        """The parts of a space and the text, each less its leading space; they begin after a gap that both leave open."""
        whole = " " + text
        if re.search(r"\s ", whole):
            return [part[1:] for part in GAP.split(whole)]
        return text.split(" ")

    def documents(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, groups_sha256); and the links as (place of the text, pair)."""
        if len(self.written) > CACHED_PARTS or self.chars > CACHED_CHARS:
            self.clear()
        split = [self.parts_of(t) if t else [] for t in texts]
        keys = list(chain.from_iterable(split))
        if not keys:
            return [(0, 0, 0, 0, "")] * len(texts), np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = list(set(keys) - self.known.keys())
        if new:
            self._learn(new)
        codes = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(counts)
        starts = ends - counts
        table = np.array([np.frombuffer(n, np.int32) for n in self.n_of]).T[codes]
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(table, axis=0, dtype=np.int64)])
        broken = np.concatenate([[0], np.cumsum(table[:, 0] < 0)])
        good = (broken[ends] == broken[starts]) & (counts > 0)
        totals = (sums[ends] - sums[starts]).tolist()
        rows, listed, written = [], codes.tolist(), self.written
        for ok, total, lo, hi in zip(good.tolist(), totals, starts.tolist(), ends.tolist()):
            text = b";".join([written[c] for c in listed[lo:hi]]) if ok else b""
            rows.append((*total, hashlib.sha256(text).hexdigest()) if ok else (0, 0, 0, 0, ""))
        keep = np.repeat(good, counts)
        place, codes = np.repeat(np.arange(len(texts)), counts)[keep], codes[keep]
        first = np.array(self.first, np.int64)
        sizes = (first[1:] - first[:-1])[codes]
        stops = np.cumsum(sizes)
        at = np.repeat(first[codes] - (stops - sizes), sizes) + np.arange(int(stops[-1]) if len(stops) else 0)
        links = np.array(self.pairs, np.int64)[at] if len(at) else np.zeros(0, np.int64)
        for key in [k for k in new if len(k) > LONG_PART]:  # hardly ever seen again
            del self.known[key]
        return rows, np.repeat(place, sizes), links


def postings(links: np.ndarray, n_b: int, chunk: int) -> pa.RecordBatch:
    """Rows ``(a, b, chunk, docs, planes)`` of links given as pair << 16 | place."""
    links.sort()
    new = np.concatenate([[True], links[1:] != links[:-1]]) if len(links) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate([at, [len(links)]])) - 1  # a bitmap tells the first link, planes the others
    keys = links[at]
    places, pairs = (keys & (CHUNK_DOCS - 1)).astype(np.int64), keys >> 16
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(times, first) if len(first) else first
    docs, planes = [], []
    for lo, hi, top in zip(first.tolist(), [*first[1:].tolist(), len(pairs)], most.tolist()):
        docs.append(pack(places[lo:hi]))
        planes.append([pack(places[lo:hi][(times[lo:hi] >> p & 1) > 0]) for p in range(top.bit_length())])
    named = pairs[first]
    return pa.RecordBatch.from_arrays([
        pa.array((named // n_b).astype(np.int32)), pa.array((named % n_b).astype(np.int32)),
        pa.array(np.full(len(named), chunk, np.int64)), pa.array(docs, pa.binary()), pa.array(planes, pa.list_(pa.binary())),
    ], names=["a", "b", "chunk", "docs", "planes"])


# --- the corpus --------------------------------------------------------------------------------

_COUNTED = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
_POSTING = T.StructType([
    T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("chunk", T.LongType()),
    T.StructField("docs", T.BinaryType()), T.StructField("planes", T.ArrayType(T.BinaryType()))])


def _encoded(docs: DataFrame, model_a: bytes, model_b: bytes, text: str) -> DataFrame:
    """One pass over whole texts: a row per document with its place, and the postings of every chunk, in one table."""
    spark = docs.sparkSession
    ship_package(spark)
    models = spark.sparkContext.broadcast((model_a, model_b))
    named = hashlib.sha256(model_a + model_b).hexdigest()
    own = docs.select(*[column(docs, c) for c in docs.columns if c != text], column(docs, text).alias("__text"))
    width = len(own.columns) - 1
    kept = [T.StructField(f"__c{i}", f.dataType) for i, f in enumerate(own.schema.fields[:-1])]
    digest = T.StructField("groups_sha256", T.StringType())
    schema = T.StructType([*kept, *_COUNTED, digest, T.StructField("place", T.IntegerType()), *_POSTING])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(schema)
        aligner = held(("alignment", named), lambda: Aligner(*models.value))
        chunk, used, chars, gathered = TaskContext.get().partitionId() << 32, 0, 0, []

        def flushed() -> pa.RecordBatch:
            rows = postings(np.concatenate(gathered), aligner.n_b, chunk)
            blank = [pa.nulls(rows.num_rows, f.type) for f in list(shape)[:-rows.num_columns]]
            return pa.RecordBatch.from_arrays([*blank, *rows.columns], schema=shape)

        for batch in batches:
            for part in slices(batch, width, 1024, 2_000_000):
                if used + part.num_rows > CHUNK_DOCS or chars > GATHERED_CHARS:
                    if gathered:
                        yield flushed()
                    gathered, chars = [], 0
                    if used + part.num_rows > CHUNK_DOCS:
                        chunk, used = chunk + 1, 0
                texts = part.column(width).to_pylist()
                rows, places, links = aligner.documents(texts)
                if len(links):
                    gathered.append(links << 16 | (places + used))
                chars += sum(map(len, filter(None, texts)))
                counted = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(shape)[width:width + 5])] if rows else []
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:width], *counted, pa.array(np.arange(used, used + n, dtype=np.int32)),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(np.full(n, chunk, np.int64)),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.binary()))], schema=shape)
                used += n
        if gathered:
            yield flushed()

    return own.mapInArrow(encode, schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in order of pair and chunk, bitmaps of one pair and chunk merged, with documents and links counted."""
    names = ["a", "b", "chunk", "docs", "planes", "n_docs", "n_links"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.int64()]
    key, docs, planes = None, [], []

    def row() -> tuple:
        # chunks are filled from one end on, so a document is in one part only and planes merge like bitmaps
        if len(docs) == 1:
            whole, levels = docs[0], planes[0]
        else:
            top = max(map(len, planes))
            whole, levels = merge(docs), [merge([p[i] for p in planes if i < len(p)]) for i in range(top)]
        found = popcount(whole)
        return *key, whole, levels, found, found + sum(popcount(p) << i for i, p in enumerate(levels))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        rows = []
        for *this, bits, levels in zip(*[c.to_pylist() for c in batch.columns]):
            if this != key:
                if key is not None:
                    rows.append(row())
                key, docs, planes = this, [], []
            docs.append(bits)
            planes.append(levels)
        if rows:
            yield table(rows)
    if key is not None:
        yield table([row()])


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scored postings in order of chunks → ``(chunk, place, n_best, count_sum)`` of the documents in them."""
    here, best, total, seen = None, None, None, None

    def table() -> pa.RecordBatch:
        at = np.flatnonzero(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), here, np.int64)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])],
            names=["chunk", "place", "n_best", "count_sum"])

    for batch in batches:
        for chunk, docs, planes, n_docs, is_best in zip(*[c.to_pylist() for c in batch.columns]):
            if chunk != here:
                if here is not None:
                    yield table()
                here = chunk
                best, total, seen = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, bool)
            places = unpack(docs)
            seen[places] = True
            total[places] += n_docs
            if is_best:
                best[places] += 1
            for i, plane in enumerate(planes):
                if plane:
                    more = unpack(plane)
                    total[more] += n_docs << i
                    if is_best:
                        best[more] += 1 << i
    if here is not None:
        yield table()


def _tasks(rows: DataFrame, each: int) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // each)


def index(encoded: DataFrame) -> DataFrame:
    """The inverted index of :func:`_encoded`: one merged posting per pair and chunk, with ``n_docs`` and ``n_links``."""
    rows = encoded.where("a is not null").select(*_POSTING.fieldNames())
    dealt = rows.repartition(_tasks(rows, 100_000), "a", "b", "chunk").sortWithinPartitions("a", "b", "chunk")
    schema = T.StructType([*_POSTING, T.StructField("n_docs", T.LongType()), T.StructField("n_links", T.LongType())])
    return write_and_read(dealt.mapInArrow(_merged, schema), "index")


def pair_counts(index: DataFrame) -> DataFrame:
    """``(a, b, n_docs, n_links, best)``: documents and links of each pair; ``best`` if no pair of ``a`` has more documents."""
    counts = index.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, model_a: bytes, model_b: bytes, text: str = "text", keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The documents' alignment, and the table of linked pairs (see :func:`pair_counts`).

    Documents are ``docs`` (or its columns ``keep``) with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links
    whose pair has the most documents of all pairs of its first id), ``count_sum`` (documents of the pairs, over
    links) and ``groups_sha256``. Texts that are null or empty, or that one of the two does not give back, have no
    tokens: zeros and an empty digest. Columns of these names are replaced; repeated rows stay and count again;
    an empty table gives empty ones. Hot pairs are spread by chunks of documents.
    """
    added = [f.name for f in _COUNTED] + ["n_best", "count_sum", "groups_sha256"]
    chosen = docs if keep is None else docs.select(*[column(docs, c) for c in dict.fromkeys([*keep, text])])
    body = "__body"
    plain = without(chosen.withColumn(body, column(chosen, text)), *added)
    if keep is not None and text not in keep:
        plain = without(plain, text)
    own = [c for c in plain.columns if c != body]
    encoded = write_and_read(_encoded(plain, model_a, model_b, body), "aligned")
    found = index(encoded)
    counts = write_and_read(pair_counts(found), "pairs")
    scored = found.select("a", "b", "chunk", "docs", "planes").join(
        counts.select("a", "b", "n_docs", "best").hint("merge"), ["a", "b"])
    scored = scored.select("chunk", "docs", "planes", "n_docs", "best")
    dealt = scored.repartition(_tasks(found, 100_000), "chunk").sortWithinPartitions("chunk")
    scores = dealt.mapInArrow(_returned, "chunk long, place int, n_best long, count_sum long")
    rows = encoded.where("place is not null").join(scores, ["chunk", "place"], "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")}
    return rows.select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(own)], *[f.name for f in _COUNTED], *zero.values(),
        "groups_sha256"), counts
