"""SentencePiece encoding with the source bytes of every piece, and decoding.

A model's normaliser is read from its file: the compiled character map is a double-array trie whose
longest prefix at each place names a replacement. Normalising records, for every byte it writes, the byte
of the source it stands for, so each piece of the normalised text projects back to a span of the original.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliary.llm.frames import column, held, slices
from foliary.llm.words import WordCache
from foliary.session import ship_package

SPACE_MARK = "▁"
MARK = SPACE_MARK.encode()
LOST = "�".encode()


class CharacterMap:
    """Longest-prefix replacements from a compiled character map (may be empty)."""

    def __init__(self, compiled: bytes):
        self.units, self.strings = np.zeros(0, np.uint32), b""
        if compiled:
            size = int.from_bytes(compiled[:4], "little")
            self.units = np.frombuffer(compiled[4:4 + size], "<u4")
            self.strings = compiled[4 + size:]
        self.trie = self.units.tolist()
        starts = {b for b in range(256) if self._begins(b)} | {32}
        #: Bytes from which on nothing is mapped and no space stands: they are written as they are.
        self.plain = re.compile(b"[^" + b"".join(re.escape(bytes([b])) for b in sorted(starts)) + b"]+")

    def _begins(self, first: int) -> bool:
        if not self.trie:
            return False
        node = self._offset(self.trie[0]) ^ first
        return node < len(self.trie) and self.trie[node] & 0x800000FF == first

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Bytes consumed and their replacement, if a prefix at ``start`` is mapped."""
        if not self.trie:
            return None
        node, best = self._offset(self.trie[0]), None
        for i in range(start, len(data)):
            node ^= data[i]
            if node >= len(self.trie):
                break
            unit = self.trie[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                best = i + 1 - start, self.trie[node] & 0x7FFFFFFF
        if best is None:
            return None
        end = self.strings.index(b"\0", best[1])
        return best[0], self.strings[best[1]:end]


@dataclass(frozen=True)
class Rules:
    dummy_prefix: bool
    remove_extra: bool
    escape: bool
    suffix: bool


def character_bytes(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def normalise(text: str, chars: CharacterMap, rules: Rules) -> tuple[bytes, list[int]]:
    """The normalised text, and for each of its bytes (and the end) the source byte it comes from.

    Stretches that no entry of the map can change are taken over at once, each byte from its own place.
    """
    data = text.encode("utf-8", "replace")
    blank = MARK if rules.escape else b" "
    out, source = bytearray(), []
    at, n = 0, len(data)

    def step(i: int) -> tuple[int, bytes]:
        found = chars.longest(data, i)
        if found is None:
            size = character_bytes(data[i])
            return size, data[i:i + size]
        return found

    def write(piece: bytes, origin: int) -> None:
        out.extend(piece)
        source.extend([origin] * len(piece))

    if rules.remove_extra:
        while at < n:
            size, piece = step(at)
            if piece != b" ":
                break
            at += size
        if at >= n:
            return b"", [0]
    elif not n:
        return b"", [0]
    if rules.dummy_prefix and not rules.suffix:
        write(blank, at)
    after_space = rules.remove_extra
    while at < n:
        plain = chars.plain.match(data, at)
        if plain is not None:
            out.extend(plain.group())
            source.extend(range(at, plain.end()))
            at, after_space = plain.end(), False
            continue
        size, piece = step(at)
        while after_space and piece.startswith(b" "):
            piece = piece[1:]
        if piece:
            for k in range(len(piece)):
                if piece[k] == 32 and rules.escape:
                    write(MARK, at)
                else:
                    write(piece[k:k + 1], at)
            after_space = piece.endswith(b" ")
        at += size
        if not rules.remove_extra:
            after_space = False
    if rules.remove_extra:
        while out.endswith(blank):
            at = source[len(out) - len(blank)]
            del out[-len(blank):]
            del source[-len(blank):]
    if rules.dummy_prefix and rules.suffix:
        write(blank, at)
    source.append(at)
    return bytes(out), source


class Encoder:
    """A SentencePiece model with its normaliser; ``encode`` gives ids and spans, ``decode`` texts."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.chars = CharacterMap(spec.precompiled_charsmap)
        self.rules = Rules(spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces,
                           proto.trainer_spec.treat_whitespace_as_suffix)
        self.kind = [p.type for p in proto.pieces]
        self.size = [len(p.piece.encode()) for p in proto.pieces]
        self.unknown = self.library.unk_id()
        self.end_id = self.library.eos_id()
        names = {p.piece for p in proto.pieces}
        # words can be encoded apart if nothing is rewritten and no piece goes on past the gap before a space
        self.apart = (
            not self.chars.trie and self.rules == Rules(True, False, True, False)
            and proto.trainer_spec.model_type == 2 and proto.trainer_spec.byte_fallback and SPACE_MARK in names
            and all(SPACE_MARK not in p.piece.lstrip(SPACE_MARK) for p in proto.pieces)
        )
        self.cache = WordCache(self._heads, self._tails, lambda w: not w or SPACE_MARK in w, most=300_000)

    def edges(self, text: str, ids: list[int]) -> list[int]:
        """Source bytes at which the pieces of this text (without control ids) begin, and where the last one ends.

        The text is normalised with its alignment, the pieces are laid along the normalised bytes, and what
        the edges between them come from is looked up. Of the byte ids that spell one character, the last has
        its span and those before are empty. A run of unknown characters is one id.
        """
        normal, source = normalise(text, self.chars, self.rules)
        edges, at, open_bytes = [source[0]], 0, 0
        for k, i in enumerate(ids):
            if self.kind[i] == 6:  # a byte
                open_bytes = (open_bytes or character_bytes(normal[at])) - 1
                if not open_bytes:
                    at += character_bytes(normal[at])
            elif i == self.unknown:
                at = self._unknown_end(normal, at, ids[k + 1] if k + 1 < len(ids) else None)
            else:
                at += self.size[i]
            edges.append(source[at])
        return edges

    def spans(self, text: str, ids: list[int]) -> np.ndarray:
        """(begin, end) source bytes of every id, see :meth:`edges`."""
        edges = self.edges(text, ids)
        return np.array([edges[:-1], edges[1:]], np.uint32).T.reshape(-1, 2)

    def _unknown_end(self, normal: bytes, at: int, following: int | None) -> int:
        stop = self.library.id_to_piece(following).encode() if following is not None else None
        at += character_bytes(normal[at])
        while at < len(normal) and (stop is None or not normal.startswith(stop, at)):
            at += character_bytes(normal[at])
        return at

    def whole(self, text: str) -> tuple[bytes, bytes, bytes]:
        """Ids, source bytes per id and decimals of a whole text."""
        return self._value(text, self.library.encode(text), gap=0)

    def _value(self, text: str, ids: list[int], gap: int) -> tuple[bytes, bytes, bytes]:
        """``gap`` source bytes stand before ``text`` and count for its first piece, as does what is left out there."""
        edges = self.edges(text, ids)
        sizes = array("I", map(sub, edges[1:], edges))
        if sizes:
            sizes[0] += gap + edges[0]
        return array("I", ids).tobytes(), sizes.tobytes(), " ".join(map(str, ids)).encode()

    def _words(self, words: list[str], gap: int) -> list[tuple[bytes, bytes, bytes]]:
        """Values of words that are encoded apart; ``gap`` is 1 if a source space stands before them."""
        found = self.library.encode(words, num_threads=1)
        return [self._value(word, ids, gap) for word, ids in zip(words, found, strict=True)]

    def _heads(self, words: list[str]) -> list[tuple]:
        return self._words(words, 0)

    def _tails(self, words: list[str]) -> list[tuple]:
        return self._words(words, 1)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes, bytes]]:
        """Per text: ids, source bytes per id (little-endian 32-bit integers), and ids in decimal."""
        if not self.apart:
            return [self.whole(t) for t in texts]
        out = []
        for text, values in zip(texts, self.cache.lists(texts), strict=True):
            if values is None:
                out.append(self.whole(text) if text else (b"", b"", b""))
                continue
            out.append((b"".join([v[0] for v in values]), b"".join([v[1] for v in values]), b" ".join([v[2] for v in values])))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _encoder(model: bytes) -> Encoder:
    return Encoder(model)


def encode_documents(
    docs: DataFrame, model: bytes, text: str = "text", keep: list[str] | None = None, lists: bool = True,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with their pieces.

    Adds ``n_tokens`` (the end id included), ``ids_sha256`` (of the decimal ids joined by one space),
    ``decoded_sha256`` (of the decoded text), ``n_bytes`` (source bytes the spans cover),
    ``spans_crc32`` (of the pieces' ends as little-endian 32-bit integers), and with ``lists`` also
    ``ids``, ``span_ends`` (the end of each piece's bytes in the source; it begins where the one before
    ends) and ``decoded``. A null text counts as empty: the end id alone. Columns of these names are
    replaced; repeated rows stay.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(model)
    digest = zlib.crc32(model)
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()),
             ("n_bytes", T.LongType()), ("spans_crc32", T.LongType())]
    if lists:
        added += [("ids", T.ArrayType(T.IntegerType())), ("span_ends", T.ArrayType(T.LongType())), ("decoded", T.StringType())]
    taken = {n for n, _ in added}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    own = docs.select(*[column(docs, c) for c in kept], column(docs, text).alias("__text"))
    schema = T.StructType([*own.schema.fields[:-1], *[T.StructField(n, t) for n, t in added]])
    names = [f.name for f in schema.fields]
    width = len(kept)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(t) for _, t in added]
        encoder = held(("pieces", digest), lambda: _encoder(shipped.value))
        for batch in batches:
            for part in slices(batch, width, 1024, 2_000_000):
                texts = [t or "" for t in part.column(width).to_pylist()]
                columns: list[list] = [[] for _ in added]
                for ids, sizes, decimals in encoder.encode(texts):
                    numbers = np.frombuffer(ids, "<u4").tolist()
                    numbers.append(encoder.end_id)
                    ends = np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)
                    decoded = encoder.decode(numbers)
                    end = str(encoder.end_id).encode()
                    row = [
                        len(numbers), hashlib.sha256(decimals + b" " + end if decimals else end).hexdigest(),
                        hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest(),
                        int(ends[-1]) if len(ends) else 0, zlib.crc32(ends.astype("<u4").tobytes())]
                    if lists:
                        row += [numbers, ends, decoded]
                    for values, value in zip(columns, row):
                        values.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], *[pa.array(v, type=t) for v, t in zip(columns, types)]], names=names)

    return own.mapInArrow(encode, schema)
