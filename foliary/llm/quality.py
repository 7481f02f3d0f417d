"""Quality classifier: averaged hashed vectors of words and character n-grams, softmax output.

Every document is the mean of the vectors of its words and of the character n-grams of each word with
its boundaries, plus one vector that every document has. A word that repeats the one before it counts as
a further word of its own ("as before"), since averages do not see order. The vectors and the output layer are learned
together by stochastic gradient descent in numpy on a bounded sample of labelled rows. With two
classes the softmax depends on one number per document, the mean over its features of (vector x
difference of the two output rows), so scoring needs one table of floats and one lookup per feature.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import add_columns, fold_of, without

SPACE = 32
WORD_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dimensions: int = 8
    shortest: int = 3
    longest: int = 4
    epochs: int = 4
    rate: float = 0.5
    seed: int = 7
    threshold: float = 0.7
    #: Bounds of the training sample: rows, characters of one text (longer ones are not learned from), characters of all.
    sample_rows: int = 4_000
    sample_text: int = 200_000
    sample_chars: int = 12_000_000
    spaces: list[int] = field(default_factory=lambda: [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])


def features(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature and, per document, where its features start (one more entry at the end).

    Texts are joined with a space before, between and after them, as one array of code points.
    """
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths + 1)])  # position of the space before each text
    space = np.isin(points, np.array(s.spaces, np.uint32)) if points.max(initial=0) > 127 else (
        (points == SPACE) | ((points >= 9) & (points <= 13)))
    text = np.where(space, np.uint32(SPACE), points)
    spaces = np.cumsum(space, dtype=np.int64)
    n = len(text)
    found, places = [], []
    hashed = text * np.uint32(0x01000193)
    for size in range(2, s.longest + 1):
        if n < size:
            break
        hashed = (hashed[:n - size + 1] ^ text[size - 1:]) * np.uint32(0x01000193)
        if size < s.shortest:
            continue
        # nothing but the ends may be a space, and not both ends of two characters
        inner = spaces[size - 2:n - 1] == spaces[:n - size + 1] if size > 2 else ~(space[:-1] & space[1:])
        at = np.flatnonzero(inner)
        mixed = hashed[at]
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * size)
        found.append((mixed ^ (mixed >> np.uint32(13))) % np.uint32(s.buckets))
        places.append(at)
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if len(starts):
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        powers = _powers(int((ends - starts).max()))
        # a word's hash: sum of code point x base^(place in the word), modulo 2^64
        inside = np.arange(n) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [n]])))
        terms = np.where(space, np.uint64(0), text.astype(np.uint64) * powers[np.minimum(inside, len(powers) - 1)])
        word = np.add.reduceat(terms, starts)
        again = starts[1:][(word[1:] == word[:-1]) & (starts[1:] - ends[:-1] == 1)]
        found.append(np.full(len(again), s.buckets - 1, np.uint32))  # the word that says "as before"
        places.append(again)
        word = (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append(((word ^ (word >> np.uint64(32))) % np.uint64(s.buckets)).astype(np.uint32))
        places.append(starts)
    if not found:
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    place, bucket = np.concatenate(places), np.concatenate(found)
    document = np.searchsorted(first, place, side="right") - 1
    order = np.argsort(document, kind="stable")
    return bucket[order], np.concatenate([[0], np.cumsum(np.bincount(document, minlength=len(texts)))[:len(texts)]])


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, WORD_BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Model:
    settings: Settings
    #: Per bucket, and at the end for the vector all documents have.
    weight: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1. A text without features has the common vector only."""
        bucket, starts = features(texts, self.settings)
        sums = np.concatenate([[0.0], np.cumsum(self.weight[bucket], dtype=np.float64)])
        sizes = np.diff(starts)
        logit = (sums[starts[1:]] - sums[starts[:-1]] + float(self.weight[-1])) / (sizes + 1)
        return 1 / (1 + np.exp(-logit))


def train(texts: list[str], labels: list[int], s: Settings | None = None) -> Model:
    """Fit on labelled texts; with one class only, every score is the smoothed share of label 1."""
    s = s or Settings()
    if len(set(labels)) < 2:
        share = (sum(labels) + 1) / (len(labels) + 1) if not labels or labels[0] else 1 / (len(labels) + 2)
        share = min(share, 1 - 1e-6)
        return Constant(s, np.zeros(s.buckets + 1, np.float32), share)
    rng = np.random.default_rng(s.seed)
    vectors = ((rng.random((s.buckets + 1, s.dimensions)) - 0.5) / s.dimensions).astype(np.float32)
    output = np.zeros((2, s.dimensions), np.float32)
    samples = []
    for i in range(0, len(texts), 256):
        bucket, starts = features(texts[i:i + 256], s)
        for a, b in zip(starts[:-1], starts[1:]):
            own, times = np.unique(bucket[a:b], return_counts=True)
            own = np.append(own.astype(np.int64), s.buckets)
            samples.append((own, np.append(times, 1).astype(np.float32)[:, None] / np.float32(b - a + 1)))
    steps, step = s.epochs * len(samples), 0
    for _ in range(s.epochs):
        for k in rng.permutation(len(samples)):
            own, share = samples[k]
            rate = s.rate * (1 - step / steps)
            rows = vectors[own]
            hidden = (rows * share).sum(axis=0)
            logit = output @ hidden
            chance = np.exp(logit - logit.max())
            error = chance / chance.sum()
            error[labels[k]] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            # fastText's convention: a feature moves by the document's error, whatever its share
            vectors[own] = rows - rate * np.minimum(share * len(own), 1) * back
            step += 1
    return Model(s, (vectors @ (output[1] - output[0])).astype(np.float32))


class Constant(Model):
    def __init__(self, settings: Settings, weight: np.ndarray, share: float):
        super().__init__(settings, weight)
        self.share = share

    def scores(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.share)


def learn(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> Model:
    """Train on labelled rows outside the held-out fold, a sample bounded by the settings.

    The sample is the labelled ids with the least hashes; their texts are fetched in one pass. Rows
    without id, label or text are not learned from.
    """
    s = s or Settings()
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 2))
    # labels first: bounded, so the join below has a small side of known size
    chosen = marked.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("label"))
    own = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("body"))
    present = own.where(F.col("body").isNotNull() & (F.length("body") <= s.sample_text)).select("__id")
    chosen = chosen.join(present, "__id", "left_semi").distinct()
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id", "label").limit(s.sample_rows)
    rows = sorted(own.join(F.broadcast(chosen), "__id").collect(), key=lambda r: (r["__id"], r["label"], r["body"] or ""))
    texts, known, used = [], [], 0
    for r in rows:
        if r["body"] is not None and len(r["body"]) <= s.sample_text and used + len(r["body"]) <= s.sample_chars:
            used += len(r["body"])
            texts.append(r["body"])
            known.append(int(r["label"]))
    return train(texts, known, s)


def with_quality(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on); null texts count as empty.

    Whole texts are scored; columns of the two names are replaced; repeated rows get equal scores.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # one float per bucket
    threshold = model.settings.threshold

    def make(texts: list) -> tuple:
        scores = shipped.value.scores([t or "" for t in texts])
        return scores, (scores >= threshold).astype(np.int32)

    return add_columns(docs, [text], [("score", T.DoubleType()), ("predicted", T.IntegerType())], make, keep,
                       rows_at_once=512, chars_at_once=1_000_000)


def keep_good(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier learned from them and ``labels`` accepts."""
    model = learn(docs, labels, s)
    held = docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    good = with_quality(held, model, at["text"]).where("predicted = 1")
    return good.select(*[F.col(new).alias(old) for old, new in at.items()])


def scored(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = learn(docs, labels, s)
    slim = without(docs.select("doc_id", "text"), "score", "predicted")
    out = with_quality(slim, model, keep=["doc_id"])
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
