"""Repair of words that text extraction split after a ligature ("confl ict" → "conflict")."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foliary.session import cut

# A left part ends in ff, fi, fl, ffi or ffl.
WORD = r"^\p{L}+$"
SPLIT_WORD = r"^\p{L}*(ff|fi|fl)$"
MAYBE_SPLIT = r"(?i)(ff|fi|fl) \p{L}"
LEADING_NONLETTERS = r"^[^\p{L}]+"
TRAILING_AFTER_LETTERS = r"[^\p{L}].*$"
# In lower case. The anchors (a word's start, or the last match's end within a word) keep letters from being tried anew
# for every place in a word; they exclude no match.
SPLIT_PART = r"f[fil] \p{L}"
LEFT_PART = r"(?:(?<!\p{L})|\G)\p{L}*(ff|fi|fl) (\p{L})"
LIGATED_WORD = r"(?<!\p{L})\p{L}*f[fil]\p{L}*"

# A first choice of words that are often split; callers add their own.
DEFAULT_WORDS = (
    "affair", "affairs", "affect", "affected", "afford", "benefit", "benefits", "briefly",
    "certificate", "classified", "coefficient", "coffee", "confident", "configuration", "confirm",
    "confirmed", "conflict", "conflicts", "conflicting", "cutoff", "deficit", "define", "defined",
    "definition", "differ", "difference", "different", "difficult", "difficulty", "effect",
    "effective", "effects", "efficient", "effort", "efforts", "field", "fields", "fifth", "fight",
    "fighting", "figure", "figures", "file", "files", "final", "finally", "finance", "financial",
    "find", "finding", "fire", "firm", "first", "five", "flag", "flat", "flight", "float", "flood",
    "floor", "flow", "fluid", "identified", "identify", "inflation", "influence", "justified",
    "modified", "offer", "offered", "office", "officer", "officers", "offices", "official",
    "officials", "offline", "profile", "profit", "profits", "reflect", "reflected", "refugee",
    "sacrifice", "scientific", "significant", "specific", "specified", "staffing", "suffer",
    "suffered", "sufficient", "traffic", "unified", "verified",
)


def heard_words(texts: DataFrame, *columns: str) -> DataFrame:
    """``(*columns, word)``: the distinct words with a ligature in each text of ``(*columns, text)``.

    A left part standing right before the letters it may have lost does not count, or common split errors would pass
    for words. Words without a ligature are never asked for, so they need not leave their document.
    """
    lowered = F.lower("text")
    heard = F.when(lowered.rlike(SPLIT_PART), F.regexp_replace(lowered, LEFT_PART, " $2")).otherwise(lowered)
    ligated = F.regexp_extract_all(heard, F.lit(LIGATED_WORD), F.lit(0))
    return texts.select(*columns, F.explode(F.array_distinct(ligated)).alias("word"))


@dataclass(frozen=True)
class Lexicon:
    """What counts as a word: ``extra``, and words in at least ``min_docs`` of ``texts`` (doc_id, text)."""

    texts: DataFrame | None = None
    min_docs: int = 2
    extra: tuple[str, ...] = DEFAULT_WORDS

    def among(self, candidates: DataFrame) -> DataFrame:
        """The candidates ``(word)``, distinct, that are words. Only candidates are counted."""
        given = candidates.where(F.col("word").isin(*[w.lower() for w in self.extra])) if self.extra else None
        if self.texts is None:
            return given if given is not None else candidates.where(F.lit(False))
        counted = (
            heard_words(self.texts).join(candidates, "word", "left_semi")
            .groupBy("word").agg(F.count("*").alias("docs")).where(F.col("docs") >= self.min_docs)
            .select("word")
        )
        return counted if given is None else counted.unionByName(given).distinct()

    def since(self, candidates: DataFrame) -> DataFrame:
        """``(word, since)`` of the candidates that are words for texts with a number above ``since``."""
        return self.among(candidates).withColumn("since", F.lit(-1).cast("bigint"))


@dataclass(frozen=True)
class ArrivalLexicon:
    """The words of ``base``, and those that ``min_docs`` documents held before the text at hand.

    ``counted``: (word, docs) of documents stored by earlier batches, in any number of rows a word; ``arriving``:
    (doc_id, seq, text) of those the batch stores. The ``min_docs``-th smallest number of a word's documents says from where
    on it counts, so what is repaired in a text depends on the documents before it and not on how a feed is cut.
    """

    base: Lexicon
    arriving: DataFrame
    counted: DataFrame | None = None
    min_docs: int = 2

    def since(self, candidates: DataFrame) -> DataFrame:
        earlier = candidates.sparkSession.createDataFrame([], "word STRING, before BIGINT")
        if self.counted is not None:
            earlier = cut(
                self.counted.join(candidates, "word", "left_semi").groupBy("word").agg(F.sum("docs").alias("before")))
        in_order = F.row_number().over(W.partitionBy("word").orderBy("seq"))
        # only the first few documents of a word leave their tasks
        first = (
            heard_words(self.arriving, "seq").join(candidates, "word", "left_semi")
            .withColumn("_rank", in_order).where(F.col("_rank") <= self.min_docs)
        )
        reached = (
            first.join(earlier, "word", "left")
            .where(F.col("_rank") + F.coalesce("before", F.lit(0)) >= self.min_docs).select("word", F.col("seq").alias("since"))
        )
        known = earlier.where(F.col("before") >= self.min_docs).select("word", F.lit(-1).cast("bigint").alias("since"))
        return self.base.since(candidates).unionByName(known).unionByName(reached).groupBy("word").agg(
            F.min("since").alias("since"))


def word_sightings(texts: DataFrame) -> DataFrame:
    """``(word, docs)``: in how many of the documents ``(doc_id, text)`` each word with a ligature stands."""
    return heard_words(texts).groupBy("word").agg(F.count("*").alias("docs"))


def _seams(tokens: Column) -> Column:
    """The two tokens around every space."""
    pairs = F.size(tokens) - 1
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs), F.slice(tokens, F.lit(2), pairs),
        lambda left, right: F.struct(left.alias("left"), right.alias("right")),
    )


def _suspect(seam: Column) -> Column:
    """Cheap first test: the left token ends in a ligature."""
    end = F.lower(F.substring(seam["left"], -2, 2))
    return end.isin("ff", "fi", "fl")


def _word_pair(seam: Column) -> Column:
    """Words (lower case) that touch the space, without leading or trailing marks."""
    return F.struct(
        F.lower(F.regexp_replace(seam["left"], LEADING_NONLETTERS, "")).alias("left"),
        F.lower(F.regexp_replace(seam["right"], TRAILING_AFTER_LETTERS, "")).alias("right"),
    )


def split_spots(texts: DataFrame) -> DataFrame:
    """Distinct ``(id, seq, left, right)`` of the spots in ``(id, seq, text)`` that look like a split word."""
    suspects = F.filter(_seams(F.split("text", " ")), _suspect)
    pairs = F.filter(
        F.transform(suspects, _word_pair), lambda p: p["left"].rlike(SPLIT_WORD) & p["right"].rlike(WORD)
    )
    return texts.where(F.col("text").rlike(MAYBE_SPLIT)).select("id", "seq", F.inline(F.array_distinct(pairs)))


def mergeable_spots(spots: DataFrame, words: DataFrame) -> DataFrame:
    """Spots whose merged form is a word by then while their left part is none; ``words``: (word, since)."""
    merged = spots.withColumn("word", F.concat("left", "right")).join(words, "word").where(F.col("since") < F.col("seq"))
    whole = words.select(F.col("word").alias("left"), F.col("since").alias("_since"))
    return merged.join(whole, "left", "left").where(
        F.col("_since").isNull() | (F.col("_since") >= F.col("seq"))).select("id", "left", "right")


def repair_ligatures(
    docs: DataFrame, lexicon: Lexicon | ArrivalLexicon, id_col: str = "doc_id", text_col: str = "text",
    seq_col: str | None = None,
) -> DataFrame:
    """Replace ``text_col`` by its repaired form.

    Only documents with a suspicious spot are joined to anything; all others pass straight through. Without any such spot
    no lexicon is looked up.
    ``text_col`` may be a field of a struct column. ``seq_col`` numbers the documents for an :class:`ArrivalLexicon`.
    """
    suspected = F.coalesce(F.col(text_col).rlike(MAYBE_SPLIT), F.lit(False))
    clean, doubtful = docs.where(~suspected), docs.where(suspected)

    number = F.lit(0) if seq_col is None else F.col(seq_col)
    spots = cut(split_spots(doubtful.select(
        F.col(id_col).alias("id"), number.cast("bigint").alias("seq"), F.col(text_col).alias("text"))))
    pairs = spots.select("left", "right").distinct()
    candidates = cut(pairs.select(
        F.explode(F.array("left", F.concat("left", "right"))).alias("word")
    ).distinct())
    if candidates.isEmpty():
        return docs
    merges = (
        mergeable_spots(spots, cut(lexicon.since(candidates)))
        .groupBy("id").agg(F.collect_set(F.struct("left", "right")).alias("_merge"))
    )
    tokens = F.split(text_col, " ")
    # The last token meets no seam (null) and gets no space behind it.
    rebuilt = F.array_join(F.zip_with(
        tokens, _seams(tokens),
        lambda token, seam: F.concat(
            token,
            F.when(seam.isNull(), "").when(~_suspect(seam), " ")
            .when(F.array_contains(F.col("_merge"), _word_pair(seam)), "").otherwise(" "),
        ),
    ), "")
    repaired = F.when(F.col("_merge").isNotNull(), rebuilt).otherwise(F.col(text_col))
    outer, _, field = text_col.partition(".")
    fixed = (
        doubtful.join(merges.withColumnRenamed("id", "_id"), F.col(id_col) == F.col("_id"), "left")
        .withColumn(outer, F.col(outer).withField(field, repaired) if field else repaired)
        .select(*docs.columns)
    )
    return clean.unionByName(fixed)
