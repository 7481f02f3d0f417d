"""Text normalisation and language identification, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.functions.once import once


def _chars(*codes: int) -> str:
    return "".join(map(chr, codes))


# Characters the normaliser looks for.
INVISIBLE = _chars(
    0xAD, 0x200B, 0x200E, 0x200F, 0x202A, 0x202B, 0x202C, 0x202D, 0x202E, 0x2060, 0xFEFF
)
JOINERS = _chars(0x200C, 0x200D)
JOINER_SCRIPTS = "".join(rf"\p{{Is{name}}}" for name in (
    "Arabic", "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu",
    "Kannada", "Malayalam", "Sinhala",
))
DASHES = _chars(0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2015, 0x2212, 0xFE58, 0xFE63, 0xFF0D)
SINGLE_QUOTES = _chars(0x2018, 0x2019, 0x201A, 0x201B)
DOUBLE_QUOTES = _chars(0x201C, 0x201D, 0x201E, 0x201F)

# Quick test whether a text may need any change: it covers all of the above, and a little more.
NEEDS_NORMALISING = r"[\u00ad\u200b-\u206f\u2212\ufe58\ufe63\ufeff\uff0d]|\s,"


def normalize_text(text: Column) -> Column:
    """Drop invisible formatting characters, tidy comma spacing, plain quotes and dashes.

    Zero-width joiners stay next to letters of scripts that need them. One scan decides whether a
    text needs any change, so clean text is passed through as it is.
    """
    # Characters without a counterpart in the second list are removed.
    seen = F.translate(
        text,
        DASHES + SINGLE_QUOTES + DOUBLE_QUOTES + INVISIBLE,
        "-" * len(DASHES) + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES),
    )
    # The look-ahead keeps the costly script tests to places that have a joiner at all.
    seen = F.regexp_replace(
        seen,
        f"(?=[{JOINERS}])((?<![{JOINER_SCRIPTS}{JOINERS}])[{JOINERS}]+|[{JOINERS}]+(?![{JOINER_SCRIPTS}{JOINERS}]))",
        "",
    )
    seen = F.regexp_replace(seen, r"\s+,", ",")
    return F.when(text.rlike(NEEDS_NORMALISING), seen).otherwise(text)


# Frequent short words of each language written in Latin letters.
STOP_WORDS = {
    "eng": ["the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "with", "as", "on",
            "are", "this", "by", "be", "not", "have", "from", "an", "he", "or", "they", "has",
            "which", "you", "were", "had", "their", "been", "will", "would", "there"],
    "spa": ["el", "los", "las", "del", "y", "en", "que", "se", "por", "con", "para", "una", "su",
            "al", "lo", "como", "más", "pero", "sus", "le", "ya", "este", "sí", "porque", "esta",
            "muy", "sin", "sobre", "también", "un", "la", "es", "hay", "cuando", "donde", "desde", "entre"],
    "por": ["o", "os", "as", "da", "do", "das", "dos", "e", "em", "no", "na", "nos", "nas", "que",
            "não", "uma", "um", "com", "para", "por", "mais", "ao", "aos", "pelo", "pela", "é",
            "este", "são", "muito", "você", "também", "isso", "foi", "ser"],
    "fra": ["le", "la", "les", "des", "du", "de", "et", "est", "un", "une", "dans", "que", "qui",
            "en", "pour", "par", "sur", "au", "aux", "ce", "cette", "il", "elle", "ne", "pas",
            "plus", "avec", "son", "sont", "nous", "vous", "mais", "ou"],
    "deu": ["der", "die", "das", "und", "ist", "in", "den", "dem", "des", "ein", "eine", "einen",
            "nicht", "von", "zu", "mit", "auf", "für", "sich", "im", "auch", "es", "an", "als",
            "werden", "aus", "er", "hat", "dass", "sie", "nach", "wird", "bei"],
}
# Letters that mark one language among those above.
MARK_LETTERS = {
    "spa": "ñ¿¡",
    "por": "ãõ",
    "fra": "œùûëîè",
    "deu": "äöüß",
}
SCRIPTS = {"rus": r"\u0400-\u052f", "ara": r"\u0600-\u06ff\u0750-\u077f\ufb50-\ufdff\ufe70-\ufefc"}
LATIN = r"\p{IsLatin}"

LANGUAGES = [*STOP_WORDS, *SCRIPTS]
UNKNOWN = "und"


def language_scores(text: Column) -> Column:
    """Array of ``(score, -rank, lang)``, one entry per language.

    Languages in Latin letters score one for every stop word and every marked letter that occurs. A
    language with a script of its own scores when that script has more letters in the text than the
    Latin one. Scores are whole numbers so that every engine agrees on them.
    """
    known = sorted({word for words in STOP_WORDS.values() for word in words})
    # ASCII text, told by its lengths, needs no scan for letters of other scripts
    foreign = (F.octet_length(text) > F.char_length(text)) & text.rlike("[" + "".join(SCRIPTS.values()) + "]")
    patterns = {"latin": LATIN} | {lang: f"[{ranges}]" for lang, ranges in SCRIPTS.items()}

    def letters(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))

    def listed(words: list[str]) -> Column:
        return F.array(*[F.lit(word) for word in words])

    counts = F.when(foreign, F.struct(*[letters(p).alias(name) for name, p in patterns.items()])).otherwise(
        F.struct(*[F.lit(0).alias(name) for name in patterns]))
    evidence = once(F.lower(text), lambda lowered: F.struct(
        F.array_intersect(F.split(lowered, r"[^\p{L}]+"), listed(known)).alias("words"),
        lowered.alias("lowered"),
        counts.alias("letters"),
    ))

    def scores(e: Column) -> Column:
        entries = []
        for rank, lang in enumerate(LANGUAGES):
            if lang in STOP_WORDS:
                score = F.size(F.array_intersect(e["words"], listed(STOP_WORDS[lang])))
                for letter in MARK_LETTERS.get(lang, ""):
                    score = score + F.contains(e["lowered"], F.lit(letter)).cast("int")
            else:
                found = e["letters"][lang]
                score = F.when(found > e["letters"]["latin"], found + 1000).otherwise(0)
            entries.append(F.struct(
                score.cast("bigint").alias("score"), F.lit(-rank).alias("rank"), F.lit(lang).alias("lang")
            ))
        return F.array(*entries)

    return once(evidence, scores)


def detect_language(text: Column) -> Column:
    """ISO 639-3 code of the language a text is written in; "und" without any evidence."""
    return once(
        F.array_max(language_scores(text)),
        lambda best: F.when(best["score"] > 0, best["lang"]).otherwise(UNKNOWN),
    )


def always_english(text: Column) -> Column:
    """Detector that lets everything pass, for feeds filtered beforehand."""
    return F.lit("eng")


DETECTORS = {"detect": detect_language, "always_english": always_english}
