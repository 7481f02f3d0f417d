"""Clean-up and language identification."""

import re

import pytest
from pyspark.sql import functions as F

from foliary.functions.text import detect_language, normalize_text
from foliary.operators.ligatures import Lexicon, heard_words, repair_ligatures


def apply(spark, texts, function):
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    return [r.o for r in frame.select("i", function(F.col("t")).alias("o")).orderBy("i").collect()]


def repaired(spark, texts, lexicon=None):
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id STRING, text STRING")
    return [r.text for r in repair_ligatures(frame, lexicon or Lexicon()).orderBy(F.col("doc_id").cast("int")).collect()]


def test_normalize(spark):
    texts = [
        "the bridge － closed at noon", "plain words stay as they were", "a ,b  , c", "“q” ‘s’ ―", "so­ft​ly﻿",
        "می‌خ", "a‌b", None, "",
    ]
    once = apply(spark, texts, normalize_text)
    assert once == [
        "the bridge - closed at noon", "plain words stay as they were", "a,b, c", "\"q\" 's' -", "softly",
        "می‌خ", "ab", None, "",
    ]
    assert apply(spark, once, normalize_text) == once


def test_ligatures(spark):
    texts = [
        "after the storm the confl ict went on", "two marks － here: a confl ict",
        "Confl ict (confl ict), off ice staff ice", "plain words stay as they were", None, "ends with ff", "ff fl ow",
    ]
    assert repaired(spark, texts) == [
        "after the storm the conflict went on", "two marks － here: a conflict",
        "Conflict (conflict), office staff ice", "plain words stay as they were", None, "ends with ff", "ff flow",
    ]


def test_lexicon_from_texts(spark):
    texts = ["the staffing, staff. ok", "staffing staff! ok", "staff ing and bluffi ng", "bluffing, no", "bluffing"]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id STRING, text STRING")
    got = repaired(spark, texts, Lexicon(frame, 2, ()))
    # "staff" is a word of its own, "bluffi" is none.
    assert got[2] == "staff ing and bluffing"


@pytest.mark.parametrize("language,text", [
    ("spa", "El tren sale de la estación por la mañana y vuelve cuando hay luz"),
    ("spa", "¿Dónde están las llaves del coche?"),
    ("por", "Não sei se o navio chega ao porto com a maré da tarde"),
    ("rus", "Поезд опоздал . холодное утро"),
    ("rus", "Ok, мы ждали на станции до вечера, но никто не пришёл"),
    ("ara", "وصل القطار إلى المحطة قبل الفجر"),
    ("eng", "The report was written for the people of this country"),
    ("und", "12345"), ("und", ""),
])
def test_language(spark, language, text):
    assert apply(spark, [text], detect_language) == [language]


SENTENCES = {
    "es": ["los barcos salen del puerto cuando sube la marea", "el panadero abre la tienda muy temprano", "ayer llovió sobre las montañas",
           "mi hermana estudia música en la escuela", "los niños juegan en el jardín de la casa"],
    "pt": ["os barcos saem do porto quando a maré sobe", "o padeiro abre a loja muito cedo", "ontem choveu sobre as montanhas",
           "minha irmã estuda música na escola", "as crianças brincam no jardim da casa"],
    "ru": ["корабли выходят из порта с приливом", "пекарь рано открывает лавку", "вчера в горах шёл дождь", "моя сестра учится музыке"],
    "ar": ["تخرج السفن من الميناء مع المد", "يفتح الخباز دكانه باكرا", "هطل المطر أمس على الجبال", "تدرس أختي الموسيقى في المدرسة"],
}


def test_learned_languages(spark):
    from foliary.functions.language import learn_languages

    rows = [(lang, t) for lang, texts in SENTENCES.items() for t in texts] + [(None, "no label"), ("xx", None)]
    model = learn_languages(spark.createDataFrame(rows, "lang STRING, text STRING").repartition(3))
    assert model.languages == ("ar", "es", "pt", "ru")
    texts = {"ES": "los niños salen de la escuela muy temprano", "PT": "as crianças saem da escola muito cedo", "RU": "дождь шёл в порту",
             "AR": "المطر على الميناء"}
    assert apply(spark, list(texts.values()), model.detect) == ["es", "pt", "ru", "ar"]
    assert apply(spark, [None, "", "123 456", "漢字"], model.detect) == ["und"] * 4
    long = "los barcos salen del puerto " * 20_000
    assert apply(spark, [long], model.detect) == ["es"]
    empty = learn_languages(spark.createDataFrame([], "lang STRING, text STRING"))
    assert empty.languages == () and apply(spark, ["text"], empty.detect) == ["und"]


def test_any_function_can_be_the_detector(spark):
    from foliary.operators.routing import gate_language

    frame = spark.createDataFrame([("a", ("hello there",)), ("b", ("bonjour",)), ("c", None)], "target_id STRING, doc STRUCT<extracted_text STRING>")
    gated = gate_language(frame.withColumn("error", F.lit(None).cast("string")), lambda t: F.when(t.startswith("hello"), "en").otherwise("fr"))
    assert {r.target_id: (r.lang, r.error) for r in gated.collect()} == {
        "a": ("en", None), "b": ("fr", "fr is not supported for: b"), "c": (None, None)}


def test_a_words_weights_are_added_up_once_in_a_task(spark):
    """Texts are told by their distinct words; no trigram of a text is looked up in Spark's expressions."""
    from foliary.functions.language import learn_languages

    taught = [("en", "the other thing"), ("en", "there they think"), ("de", "der dieser Dieb"), ("de", "den die dieb"), (None, "zzz")]
    model = learn_languages(spark.createDataFrame(taught, "lang STRING, text STRING"))
    weights = dict(model.weights)

    def told(text):
        words = {w for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()}
        found = [weights[g] for w in words for g in (f" {w} "[i:i + 3] for i in range(len(w))) if g in weights]
        sums = [sum(f) for f in zip(*found)]
        return model.languages[sums.index(max(sums))] if found else "und"

    texts = [None, "", "123", "zzz zz", "the the THE der", "die die other", "Dieb, think!", "a b c", "thé ther-der", "x" * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").select("i", model.detect(F.col("text")).alias("lang"))
    assert {r.i: r.lang for r in rows.collect()} == {i: told(t) for i, t in enumerate(texts)}
    assert "substring" not in rows._jdf.queryExecution().optimizedPlan().toString()


class _NeverAsked:
    def since(self, candidates):
        raise AssertionError("a lexicon was looked up though no text has a suspicious spot")


def test_texts_without_a_split_word_ask_no_lexicon(spark):
    texts = ["a-ff b", "stiff", "no such word", None, ""]  # the first looks split to the first test only
    assert repaired(spark, texts, _NeverAsked()) == texts


def _heard(text):
    """The words with a ligature, told letter by letter."""
    seen, words = re.sub(r"[^\W\d_]*(ff|fi|fl) ([^\W\d_])", r" \2", text.lower()), set()
    for word in re.split(r"[\W\d_]+", seen):
        if re.search("ff|fi|fl", word):
            words.add(word)
    return words


def test_heard_words_are_those_of_every_place(spark):
    texts = [
        "off affi x ff fi a", "staff ices of the office", "Offer, sUFFer ff1 fl-at flat", "x ff ff ffl fla éffi ñ", "no such word",
        "a" * 30 + "ffi " + "b" * 30 + "fl", "ff ", "fl o1fl o", "",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    found = {i: set() for i in range(len(texts))}
    for row in heard_words(frame, "i").collect():
        found[row.i].add(row.word)
    assert found == {i: _heard(t) for i, t in enumerate(texts)}


def test_script_letters_are_looked_for_once(spark):
    frame = spark.createDataFrame([("привет the мир",), ("مرحبا",), ("the and of",), ("1 € 2",), (None,)], "t STRING")
    told = frame.select(detect_language(F.col("t")).alias("o"))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(") + plan.count("RLIKE [") + plan.count("rlike(") <= 1
    assert [r.o for r in told.collect()] == ["rus", "ara", "eng", "und", "und"]
