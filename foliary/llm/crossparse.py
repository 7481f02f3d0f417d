"""Language identification by cross-parsing.

A text is parsed against labelled text of each language into the fewest phrases that a greedy reader
makes: every phrase is the longest match that occurs anywhere in that language's text (or one unknown
character). The suffix automaton of a language's text accepts exactly the strings that occur in it,
so the reader walks its transitions and starts a new phrase at its root when there is none. The
language with the lowest phrases x log2(training length) / length wins.

The edges of all automata lie in one table, with many letters a hash table of under 3 edges a symbol, and many
windows of text walk it in lockstep.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import add_columns, column, fold_of, held

UNKNOWN, GAP, LETTERS_FROM = 0, 1, 2
UND = "und"


@dataclass(frozen=True)
class Settings:
    #: Bounds of the training sample: languages (those with most labelled rows), documents per language, symbols
    #: of one document, symbols per language.
    languages: int = 256
    sample_documents: int = 64
    document_symbols: int = 2_000
    language_symbols: int = 24_000
    all_symbols: int = 600_000
    #: So many pairs of state and symbol are kept as a plain table (4 bytes each), more as a hash table of edges.
    table_places: int = 16_000_000
    #: Windows in which a text is parsed; each begins a phrase. All windows of a text are parsed.
    window: int = 512
    sharpness: float = 8.0


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in following[p]:
            following[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = following[p][symbol]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(symbol) == q:
                    following[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return following


class Edges:
    """A hash table from (state, symbol) to the state that follows, asked for many pairs at once."""

    EMPTY = -1
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())  # at least half of the slots are free
        self.keys = np.full(1 << self.bits, self.EMPTY, np.int64)
        self.to = np.zeros(1 << self.bits, np.int32 if to.max(initial=0) < 1 << 31 else np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = keys[left[free]]  # of several that meet in a slot one stays
            placed = self.keys[slot] == keys[left]
            self.to[slot[placed]] = to[left[placed]]
            left, slot = left[~placed], self._next(slot[~placed])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * self.SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return slot + 1 & (1 << self.bits) - 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The states that follow, -1 where there is no edge."""
        slot = self._slot(keys)
        there = self.keys.take(slot)
        found = np.where(there == keys, self.to.take(slot), -1)
        left = np.flatnonzero((there != keys) & (there != self.EMPTY))
        slot = slot[left]
        while len(left):
            slot = self._next(slot)
            there = self.keys.take(slot)
            hit = there == keys[left]
            found[left[hit]] = self.to[slot[hit]]
            more = ~hit & (there != self.EMPTY)
            left, slot = left[more], slot[more]
        return found


class Table:
    """The same for few letters: a place for every pair, so a look-up is one read."""

    def __init__(self, keys: np.ndarray, to: np.ndarray, places: int):
        self.to = np.full(places, -1, np.int32)
        self.to[keys] = to

    def find(self, keys: np.ndarray) -> np.ndarray:
        return self.to.take(keys)


class Parser:
    """Counts phrases of many texts against all languages at once.

    On a missing edge the phrase so far ends and the symbol begins the next one; an unknown symbol is a phrase
    of its own. What happens then depends on language and symbol only: ``fallback`` holds
    ``next state * 4 + phrases that end before it``, one phrase less where none is open.
    """

    def __init__(self, training: dict[str, str], settings: Settings | None = None):
        self.settings = settings or Settings()
        self.languages = sorted(training)
        letters = sorted({c for text in training.values() for c in text.lower() if c.isalpha()})
        code = {c: LETTERS_FROM + i for i, c in enumerate(letters)}
        self.width = LETTERS_FROM + len(letters)
        # symbol of every code point: letters without regard to case, everything else is a gap
        table = np.full(0x110000, GAP, np.min_scalar_type(self.width))
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                table[point] = code.get(c, code.get(c.lower(), UNKNOWN) if len(c.lower()) == 1 else UNKNOWN)
        self.symbol = table
        self.fallback = np.empty((len(self.languages), self.width), np.int64)
        roots, bits, keys, to, base = [], [], [], [], 0
        for k, language in enumerate(self.languages):
            symbols = self.symbols(training[language])
            bits.append(np.log2(max(2, len(symbols))))
            states = automaton(symbols.tolist())
            self.fallback[k] = base * 4 + 2
            for c, after in states[0].items():
                self.fallback[k, c] = (base + after) * 4 + 1
            for i, following in enumerate(states, base):
                keys.extend(i * self.width + c for c in following)
                to.extend(base + after for after in following.values())
            roots.append(base)
            base += len(states)
        self.bits, self.roots = bits, np.array(roots, np.int64)[:, None]
        found = np.array(keys, np.int64), np.array(to, np.int64)
        places = base * self.width
        self.edges = Table(*found, places) if places <= self.settings.table_places else Edges(*found)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text; runs of non-letters are one gap."""
        found = self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != GAP) | (found[:-1] != GAP)
        return found[keep]

    def phrases(self, rows: list[np.ndarray]) -> np.ndarray:
        """Phrases of each row of symbols (rows x languages)."""
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        window = self.settings.window
        per_row = -(-sizes // window)
        owner = np.repeat(np.arange(len(rows)), per_row)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        start = begins[owner] + place * window
        size = np.minimum(window, begins[owner + 1] - start)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        counts = np.zeros((len(self.languages), len(start)), np.int32)
        state = np.repeat(self.roots, len(start), axis=1)
        active = np.searchsorted(-size, -np.arange(window), side="left")  # windows longer than t
        for t in range(int(size.max(initial=0))):
            a = active[t]
            symbol = flat[start[:a] + t].astype(np.int64)
            at = state[:, :a]
            to = self.edges.find((at * self.width + symbol).ravel()).reshape(at.shape)
            of, missing = np.nonzero(to < 0)
            otherwise = self.fallback[of, symbol[missing]] - (at[of, missing] == self.roots[of, 0])
            counts[of, missing] += (otherwise & 3).astype(np.int32)
            state[:, :a] = to
            state[of, missing] = otherwise >> 2
        counts += state != self.roots  # the phrase still open at the end
        out = np.zeros((len(rows), len(self.languages)), np.int64)
        np.add.at(out, owner, counts.T)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and confidence; ``und`` and 0 without letters or without languages."""
        rows = [self.symbols(t) for t in texts]
        some = [i for i, r in enumerate(rows) if (r != GAP).any()] if self.languages else []
        names, scores = [UND] * len(texts), [0.0] * len(texts)
        if some:
            sizes = np.array([len(rows[i]) for i in some])
            cost = self.phrases([rows[i] for i in some]) * np.array(self.bits) / sizes[:, None]  # bits a symbol
            best = cost.argmin(axis=1)  # of equal languages the first by name
            chance = np.exp2(-self.settings.sharpness * (cost - cost.min(axis=1, keepdims=True)))
            share = chance.max(axis=1) / chance.sum(axis=1)
            for i, b, c in zip(some, best.tolist(), share.tolist(), strict=True):
                names[i], scores[i] = self.languages[b], c
        return names, scores


def training_texts(docs: DataFrame, s: Settings | None = None, text: str = "text", lang: str = "lang") -> dict[str, str]:
    """Labelled text per language from outside the held-out fold, bounded by the settings.

    Per language the documents with the least hashes of their ids are taken, in that order, and of
    each at most ``document_symbols`` characters; of rows that share an id and a language, the text with the least
    hash. Rows without id, text or language teach nothing. What reaches the driver is cut to the settings before.
    """
    s = s or Settings()
    known = docs.select(column(docs, "doc_id").alias("id"), column(docs, text).alias("body"), column(docs, lang).alias("name"))
    known = known.where("id is not null and body is not null and name is not null").where(fold_of(F.col("id")) != 2)
    commonest = known.groupBy("name").count().orderBy(F.desc("count"), "name").limit(s.languages).select("name")
    # the rank filter keeps a few rows per language before any shuffle
    order = Window.partitionBy("name").orderBy("hash", "id")
    ranked = known.select("name", "id", F.xxhash64("id").alias("hash")).withColumn("rank", F.dense_rank().over(order))
    chosen = ranked.where(F.col("rank") <= s.sample_documents).select("name", "id", "rank").distinct().join(commonest, "name")
    part = F.substring("body", 1, s.document_symbols).alias("body")
    rows = known.join(F.broadcast(chosen), ["name", "id"]).groupBy("name", "rank").agg(
        F.min(F.struct(F.xxhash64("body"), part)).getField("body").alias("body"))
    before = F.sum(F.length("body") + 1).over(Window.partitionBy("name").orderBy("rank")) - F.length("body") - 1
    rows = rows.withColumn("before", before).where(F.col("before") < s.language_symbols).collect()
    found: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["name"], r["rank"])):
        found.setdefault(r["name"], []).append(r["body"])
    most = max(2_000, min(s.language_symbols, s.all_symbols // max(1, len(found))))
    texts = {name: " ".join(bodies)[:most] for name, bodies in found.items()}
    return {name: t for name, t in texts.items() if any(c.isalpha() for c in t)}


def with_language(
    docs: DataFrame, training: dict[str, str], s: Settings | None = None, text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    ``und`` (score 0) for null texts and texts without a letter. Whole texts are parsed; columns of the
    two names are replaced. Ties go to the first language by name.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(training)  # bounded by the settings
    key = ("cross parser", hash(tuple(sorted(training.items()))), s)

    def make(texts: list) -> tuple:
        return held(key, lambda: Parser(shipped.value, s)).predict([t or "" for t in texts])

    return add_columns(docs, [text], [("lang_pred", T.StringType()), ("score", T.DoubleType())], make, keep)


def predicted(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``; a row without an id is not held out."""
    slim = docs.select("doc_id", "text", "lang")
    out = with_language(slim, training_texts(slim, s), s, keep=["doc_id"])
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """The rows whose text has a letter. Each of them is given a learned language, however little of it is known."""
    training = training_texts(docs, s)
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[column(docs, c).alias(n) for c, n in names.items()])
    out = with_language(renamed, training, s, names["text"]).where(F.col("lang_pred") != UND)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
