"""Encode whole texts word by word with a cache.

A tokenizer whose tokens never span the gap before a space gives the same ids for a text as for its
space-separated words one after another. Words repeat, so most of them need one dictionary lookup.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GAP = re.compile(r"(?<=\S)(?= )")
CACHED_WORDS = 600_000
#: Inside a word: before the marks that end it or its line, and around a line break.
BREAK = re.compile(r"(?<=[^\W_])(?=[.,;:!?]+(?:\n[^\W_]|\Z))|(?<=[\w.,;:!?])(?=\n[^\W_])|(?<=[\w.,;:!?]\n)(?=[^\W_])")

#: Marks that end a word, and what they may follow: letters and numbers of old, on which all Unicode tables agree.
MARKS = ".,;:!?#$%&*"
ENDS = frozenset(chr(c) for lo, hi in (
    (0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x391, 0x3A1), (0x3A3, 0x3CE),
    (0x400, 0x481), (0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A), (0x905, 0x939), (0xE01, 0xE30), (0x3041, 0x3094),
    (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)) for c in range(lo, hi + 1))
LONGEST_CACHED = 128


class WordCache:
    """``head(word)`` values for a text's first word and ``tail(word)`` values for the words after a space.

    ``encode_heads`` and ``encode_tails`` turn a list of words into their values (bytes of ids);
    ``unsafe(word)`` marks words that must not be cut off, and whose text is encoded as a whole. The
    size bound is one of memory only: a full cache starts anew.
    """

    def __init__(self, encode_heads: Callable, encode_tails: Callable, unsafe: Callable, most: int = CACHED_WORDS):
        self.encode_heads, self.encode_tails, self.unsafe, self.most = encode_heads, encode_tails, unsafe, most
        self.heads: dict = {}
        self.tails: dict = {}

    def lists(self, texts: list[str]) -> list[list | None]:
        """Each text's values, its first word's in front; None for texts with unsafe words."""
        if len(self.tails) + len(self.heads) > self.most:
            self.heads, self.tails = {}, {}
        split = [t.split(" ") for t in texts]
        firsts = [words.pop(0) for words in split]
        self._fill(self.heads, {w for w in firsts if w not in self.heads}, self.encode_heads)
        known = self.tails.get
        found = [list(map(known, words)) for words in split]
        new: set = set()
        gaps = []
        for words, values in zip(split, found, strict=True):
            if None in values:
                at = list(compress(range(len(values)), map(not_, values)))
                gaps.append((words, values, at))
                new.update(map(words.__getitem__, at))
        new -= self.tails.keys()  # words known to be unsafe
        self._fill(self.tails, new, self.encode_tails)
        for words, values, at in gaps:
            for i in at:
                values[i] = self.tails[words[i]]
        out: list[list | None] = []
        for first, values in zip(firsts, found, strict=True):
            values.insert(0, self.heads[first])
            out.append(None if False in values else values)
        return out

    def values(self, texts: list[str], whole: Callable) -> list[bytes]:
        """The joined values of each text; ``whole(text)`` for texts with unsafe words."""
        return [whole(t) if found is None else b"".join(found) for t, found in zip(texts, self.lists(texts), strict=True)]

    def _fill(self, into: dict, words: set[str], encode: Callable) -> None:
        into.update(dict.fromkeys(words, False))  # what stays False is unsafe
        safe = [w for w in words if not self.unsafe(w)]
        if safe:
            into.update(zip(safe, encode(safe), strict=True))


class Known:
    """Values by word, in Arrow columns. A full one keeps the half asked for last, or what the last call asked for."""

    def __init__(self, most: int = CACHED_WORDS):
        self.most, self.now = most, 0
        self.words, self.values = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.asked = np.zeros(0, np.int64)

    def look(self, words: pa.Array, encode: Callable) -> pa.Array:
        """The values of distinct words; ``encode`` makes those of words not known."""
        if len(self.words) > self.most:
            kept = self.asked > min(np.median(self.asked), self.now - 1)
            self.words, self.values = self.words.filter(pa.array(kept)), self.values.filter(pa.array(kept))
            self.asked = self.asked[kept]
        self.now += 1
        self.words = self.words.cast(words.type)
        at = pc.index_in(words, value_set=self.words)
        missing = pc.is_null(at)
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        self.asked[at[at >= 0]] = self.now
        new = words.filter(missing)
        if not len(new):
            return self.values.take(pa.array(at))
        made = pa.array(encode(strings(new)), pa.large_binary())
        at[at < 0] = len(self.words) + np.arange(len(new))
        found = pa.concat_arrays([self.values, made]).take(pa.array(at))
        short = pc.less_equal(pc.binary_length(new), LONGEST_CACHED)
        new, made = new.filter(short), made.filter(short)
        self.words, self.values = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.values, made])
        self.asked = np.concatenate([self.asked, np.full(len(new), self.now)])
        return found


class ColumnIds:
    """Ids of the whole texts of an Arrow column, as bytes, through the distinct words of the column.

    ``encode_heads`` turns words into ids (bytes) as a text starts with them, ``encode_tails`` as they follow a
    space. With ``breaks``, words are made of their parts at ``BREAK`` and before their last ``MARKS``; the tokenizer
    must cut there, too. ``encode_whole(text)`` serves texts with words that cannot be cut off (empty, or ending in
    white space).
    """

    def __init__(self, encode_heads: Callable, encode_tails: Callable, encode_whole: Callable, breaks: bool):
        self.encode, self.encode_whole, self.breaks = (encode_heads, encode_tails), encode_whole, breaks
        self.known = (Known(), Known())

    def _parts(self, parts: pa.Array, after_space: bool) -> pa.Array:
        """Values of words that are not cut further."""
        coded = parts.dictionary_encode()
        return self.known[after_space].look(coded.dictionary, self.encode[after_space]).take(coded.indices)

    def _words(self, words: pa.Array, after_space: bool) -> pa.Array:
        """Values of distinct words."""
        if not self.breaks or not len(words):
            return self._parts(words, after_space)
        stems = pc.utf8_rtrim(words, characters=MARKS)
        lined = pc.match_substring(words, "\n").to_numpy(zero_copy_only=False)
        marked = pc.not_equal(pc.binary_length(stems), pc.binary_length(words)).to_numpy(zero_copy_only=False)
        marked &= ends_in(stems, ENDS.__contains__) & ~lined
        lined, marked = np.flatnonzero(lined), np.flatnonzero(marked)
        broken = [BREAK.split(w) for w in strings(words.take(pa.array(lined)))]
        cut = strings(stems.take(pa.array(marked)))
        marks = [w[len(s):] for w, s in zip(strings(words.take(pa.array(marked))), cut, strict=True)]
        # first parts in the words' places, further parts behind them, then all parts in the words' order
        place = np.arange(len(words))
        place[marked] = len(words) + np.arange(len(marked))
        place[lined] = len(words) + len(marked) + np.arange(len(lined))
        first = pa.concat_arrays([words, pa.array(cut + [p[0] for p in broken], words.type)]).take(pa.array(place))
        more = pa.array(marks + [p for parts in broken for p in parts[1:]], words.type)
        extra = np.array([len(parts) - 1 for parts in broken], np.int64)
        owner = np.concatenate([np.arange(len(words)), marked, np.repeat(lined, extra)])
        values = pa.concat_arrays([self._parts(first, after_space), self._parts(more, False)])
        return joined(values.take(pa.array(np.argsort(owner, kind="stable"))), np.bincount(owner, minlength=len(words)))

    def _table(self, words: pa.Array, after_space: bool) -> tuple[pa.Array, np.ndarray]:
        """Values of distinct words, and which of them cannot be cut off (their values are empty)."""
        uncut = ends_in(words, lambda c: not c or c.isspace())
        if not uncut.any():
            return self._words(words, after_space), uncut
        values = self._words(words.filter(pa.array(~uncut)), after_space)
        place = np.where(uncut, len(values), np.cumsum(~uncut) - 1)
        return pa.concat_arrays([values, pa.array([b""], values.type)]).take(pa.array(place)), uncut

    def values(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        if not len(texts):
            return []
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")  # one word at least
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().copy()
        starts = np.cumsum(counts) - counts
        heads, at = np.unique(codes[starts], return_inverse=True)
        codes[starts] = len(coded.dictionary) + at
        tables = [self._table(coded.dictionary, True), self._table(coded.dictionary.take(pa.array(heads)), False)]
        table, uncut = pa.concat_arrays([t for t, _ in tables]), np.concatenate([u for _, u in tables])
        found = joined(table.take(pa.array(codes)), counts)
        out = strings(found)
        if uncut.any():
            for i in np.flatnonzero(np.logical_or.reduceat(uncut[codes], starts)).tolist():
                out[i] = self.encode_whole(texts[i].as_py() or "")
        return out


def strings(column: pa.Array) -> list[str]:
    """The values of an Arrow column, without a scalar object for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def ends_in(words: pa.Array, kind: Callable) -> np.ndarray:
    """For which words ``kind`` holds of the last character (of "" for empty words)."""
    last = pc.utf8_slice_codeunits(words, -1).dictionary_encode()
    return np.array([kind(c) for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]


def joined(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """``counts`` values after one another made one, without a copy."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pa.LargeBinaryArray.from_buffers(
        values.type, len(counts), [None, pa.py_buffer(offsets[ends].astype(np.int64)), values.buffers()[2]])
