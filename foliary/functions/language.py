"""Language of a text by character trigrams whose weights are learned from labelled texts.

Learning counts, per language, the trigrams of each text's distinct words over all labelled rows, and keeps the most frequent
ones. A model is a small table, given to the tasks; Spark splits the texts into words, and a task adds up the weights of
each word it meets once. Weights are whole numbers, so every engine adds them up alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foliary.functions.once import once

UNKNOWN = "und"


def distinct_words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), "")


def trigrams_of(word: Column) -> Column:
    """Trigrams of a word with a space on both sides."""
    return once(F.concat(F.lit(" "), word, F.lit(" ")), lambda framed: F.transform(
        F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(framed, i, F.lit(3))))


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: one number per language of ``languages`` for each trigram."""

    languages: tuple[str, ...]
    weights: tuple[tuple[str, tuple[int, ...]], ...]

    def detect(self, text: Column) -> Column:
        """The language with the greatest sum of weights, the first of several; "und" without a known trigram."""
        if not self.languages:
            return F.lit(UNKNOWN)
        return _best_language(self.languages, dict(self.weights))(distinct_words(F.coalesce(text, F.lit(""))))


def _best_language(languages: tuple[str, ...], weights: dict[str, tuple[int, ...]]) -> Callable[[Column], Column]:
    """Column function from a text's distinct words; a word's weights are added up once in a task."""
    width, unknown, most = len(languages) + 1, UNKNOWN, 1 << 17
    places: dict[str, int] = {}
    sums: list = []

    def place(word: str) -> int:
        framed = f" {word} "
        found = [weights[g] for g in (framed[i:i + 3] for i in range(len(word))) if g in weights]
        sums.append((len(found), *map(sum, zip(*found))) if found else (0,) * width)
        places[word] = len(sums) - 1
        return places[word]

    def best(texts):
        import numpy
        import pandas

        if len(places) > most:
            places.clear()
            sums.clear()
        at = [[places[w] if w in places else place(w) for w in words] for words in texts]
        table = numpy.array(sums, dtype="int64").reshape(len(sums), width)
        told = []
        for rows in at:
            total = table[rows].sum(axis=0) if rows else None
            told.append(unknown if total is None or not total[0] else languages[int(total[1:].argmax())])
        return pandas.Series(told, dtype=object)

    return F.pandas_udf(best, "string", F.PandasUDFType.SCALAR)


def learn_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1500) -> LanguageModel:
    """A model of the languages that label rows of ``labelled``; rows without a label or text teach nothing.

    All labelled rows are counted, in their tasks first; the table that reaches the driver has at most
    ``per_language`` trigrams for each language.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # a word's trigrams are made once for all texts that hold it
    words = rows.select(F.col(lang).alias("lang"), F.explode(distinct_words(F.col(text))).alias("word")).groupBy(
        "lang", "word").agg(F.count("*").alias("n"))
    counts = words.select("lang", "n", F.explode(trigrams_of(F.col("word"))).alias("gram")).groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    ranked = counts.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    chosen = ranked.where(F.col("_rank") <= per_language).select("gram").distinct()
    found = counts.join(chosen, "gram").select("lang", "gram", "n").collect()
    languages = tuple(sorted({r.lang for r in found}))
    grams: dict[str, dict[str, int]] = {}
    for r in found:
        grams.setdefault(r.gram, {})[r.lang] = r.n
    return LanguageModel(languages, tuple(_weights(grams, languages).items()))


def _weights(grams: dict[str, dict[str, int]], languages: tuple[str, ...]) -> dict[str, tuple[int, ...]]:
    """A thousand times the logarithm of each trigram's share in a language, half a sighting added everywhere."""
    from math import floor, log

    totals = {lang: sum(by.get(lang, 0) for by in grams.values()) + 0.5 * len(grams) for lang in languages}
    return {gram: tuple(floor(1000 * log((by.get(lang, 0) + 0.5) / totals[lang]) + 0.5) for lang in languages)
            for gram, by in sorted(grams.items())}
