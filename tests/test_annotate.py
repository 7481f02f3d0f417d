"""Annotators: running, retrying, judging and attaching results."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foliary.functions.documents import (
    annotation_from_json,
    annotation_to_json,
    document_from_json,
    document_record,
    document_to_json,
    fill_tag_values,
    tags_fit,
)
from foliary.operators import annotate as A
from foliary.operators import outputs as O
from foliary.operators.tables import append_annotations


def documents(spark, *texts):
    rows = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id STRING, t STRING")
    return rows.select("doc_id", document_record({}, document_id=F.col("doc_id"), extracted_text=F.col("t")).alias("doc"))


def tags(*offsets):
    return {"type": "tags", "label": "whatever", "version": "1", "class": "derived", "content": [
        {"offset_start": a, "offset_end": b, "tag": "T"} for a, b in offsets]}


def results(spark, texts, *annotators):
    return {(r.doc_id, r.label): r for r in A.annotate(documents(spark, *texts), annotators).collect()}


def test_tag_values_are_filled_in(spark):
    filling = A.Annotator("fill", function=lambda d: tags((0, 4), (8, 11)), post_process=True)
    plain = A.Annotator("plain", function=lambda d: tags((0, 4), (8, 11)))
    got = results(spark, ["code is fun", "", None], filling, plain)
    assert set(got) == {("d0", "fill"), ("d0", "plain")}
    assert [t.value for t in got["d0", "fill"].annotation.tags] == ["code", "fun"]
    assert [t.value for t in got["d0", "plain"].annotation.tags] == [None, None]
    assert got["d0", "fill"].annotation.label == "fill"


def test_offsets_outside_the_text_fail(spark):
    got = results(spark, ["short"], A.Annotator("x", function=lambda d: tags((0, 99)), post_process=True))
    assert (got["d0", "x"].status, got["d0", "x"].error) == ("failed", "tag offsets outside the text")


def test_utf16_offsets(spark):
    frame = spark.createDataFrame([("🇧🇷 ok",), ("é ok",)], "t STRING").selectExpr(
        "t", "array(named_struct('offset_start', length(t) - 2 + if(t like 'é%', 0, 2), 'offset_end', length(t) + if(t like 'é%', 0, 2), "
        "'value', cast(null as string), 'tag', 'T', 'score', 1D)) tags")
    rows = frame.select(fill_tag_values(F.col("tags"), F.col("t")).alias("f"), tags_fit(F.col("tags"), F.col("t")).alias("ok")).collect()
    assert [(r.f[0].value, r.ok) for r in rows] == [("ok", True), ("ok", True)]


def failing(document):
    raise RuntimeError("status 500")


def test_partial_failure_and_retries(spark):
    good = A.Annotator("good", function=lambda d: {"type": "text", "content": "fine"})
    bad = A.Annotator("bad", function=failing, retry_count=2, retry_pause_ms=0)
    none = A.Annotator("none", function=lambda d: None)
    empty = A.Annotator("empty", function=lambda d: {"type": "facets", "content": []})
    frame = A.annotate(documents(spark, "text"), [good, bad, none, empty])
    got = {r.label: r for r in frame.collect()}
    assert {k: r.status for k, r in got.items()} == {"good": "result", "bad": "failed", "none": "none", "empty": "none"}
    assert (got["bad"].attempts, got["bad"].error) == (3, "RuntimeError: status 500")
    assert got["good"].annotation.text == "fine"
    done = A.annotation_complete(frame, 4).first()
    assert (done.done, done.complete) == (4, True)
    status = {(r.stage, r.status) for r in O.annotator_status(frame, F.lit(1)).collect()}
    assert status == {("good", "SUCCESS"), ("bad", "FAILURE"), ("none", "SUCCESS"), ("empty", "SUCCESS")}
    assert [(r.operation, r.error_msg) for r in A.annotation_errors(frame).collect()] == [("bad", "RuntimeError: status 500")]


def test_flaky_annotator_recovers(spark):
    def flaky(document, calls=[]):  # noqa: B006 - the list lives as long as the worker's function
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("not yet")
        return {"type": "dictionary", "content": {"calls": str(len(calls))}}

    got = results(spark, ["text"], A.Annotator("f", function=flaky, retry_count=6, retry_pause_ms=0))["d0", "f"]
    assert (got.status, got.attempts, got.annotation.dictionary) == ("result", 3, {"calls": "3"})


def test_columns_and_functions_together(spark):
    def upper(doc):
        return F.from_json(F.to_json(F.struct(F.lit("text").alias("type"), F.upper(doc["extracted_text"]).alias("text"))), A.ANNOTATION)

    got = results(spark, ["ab"], A.Annotator("f", function=lambda d: {"type": "text", "content": d["document_id"]}), A.Annotator("c", column=upper))
    assert (got["d0", "f"].annotation.text, got["d0", "c"].annotation.text) == ("d0", "AB")
    assert (got["d0", "f"].position, got["d0", "c"].position) == (0, 1)


def test_results_are_appended_and_announced(spark):
    docs = documents(spark, "ab", "cd")
    run = A.annotate(docs, [A.Annotator("x", function=lambda d: {"type": "text", "content": "1"}), A.Annotator("y", function=lambda d: {"type": "text", "content": "2"})])
    corpus = append_annotations(docs.select("doc.*"), A.additions(run))
    assert [[a.label for a in r.annotations] for r in corpus.collect()] == [["x", "y"], ["x", "y"]]
    again = append_annotations(corpus, A.additions(run).where("seq = 0"))
    assert [a.label for a in again.first().annotations] == ["x", "y", "x"]
    replaced = append_annotations(corpus, A.additions(run).where("seq = 0"), replace=True)
    assert [a.label for a in replaced.first().annotations] == ["y", "x"]
    tenants = spark.createDataFrame([("t", "d0"), ("u", "d0")], "tenant STRING, doc_id STRING")
    ontologies = spark.createDataFrame([("t", "old", 1), ("t", "new", 2)], "tenant STRING, id STRING, version INT")
    notices = [json.loads(r.value) for r in A.annotation_notices(docs, run, tenants, ontologies).collect()]
    new = [{"tenant": "t", "id": "new"}]
    assert {(n["document"]["document_id"], str(n["ontologies"])) for n in notices} == {("d0", str(new)), ("d1", "[]")}
    # Each notice carries its own annotation only.
    assert sorted(len(n["document"]["annotations"]) for n in notices) == [1, 1, 1, 1]
    assert A.annotation_notices(docs, run, tenants, ontologies, stream_updates=False).count() == 0


def test_definitions(spark):
    given = A.definitions_frame(spark, [("a", None, 80, True, "p"), ("b", "own", 81, False, "p"), ("b", "own", 81, False, "p")])
    rows = {r.label: r for r in A.annotator_defs(given, "shared", 6, 1000).collect()}
    assert (rows["a"].host, rows["b"].host, len(rows), rows["a"].retry_count) == ("shared", "own", 2, 6)
    with pytest.raises(PySparkException, match="an annotator needs a host of its own or a shared one: a"):
        A.annotator_defs(given, None, 6, 1000).collect()
    defs = A.annotator_defs(given, "shared", 6, 1000)
    assert A.enabled_annotators(defs, None).count() == 2
    assert [r.label for r in A.enabled_annotators(defs, " b,c ").collect()] == ["b"]


def test_document_json_and_back(spark):
    docs = documents(spark, "some “text”").withColumn("doc", F.col("doc").withField("labels", F.array(F.lit("l"))))
    run = A.annotate(docs, [A.Annotator(k, function=f) for k, f in {
        "t": lambda d: tags((0, 1)), "g": lambda d: {"type": "genealogy", "content": {"similar_documents": {"a": 0.25}, "similarity_matrix": [[1.0]]}},
        "q": lambda d: {"type": "text", "content": 'quote " and \\ slash'}, "tr": lambda d: {"type": "translation", "content": {"en": "x"}},
    }.items()])
    grown = append_annotations(docs.select("doc.*"), A.additions(run))
    doc = grown.select(F.struct(*grown.columns).alias("doc"))
    row = doc.select("doc", document_to_json(F.col("doc")).alias("j")).select("doc", "j", document_from_json(F.col("j")).alias("back")).first()
    assert row.back == row.doc
    assert json.loads(row.j)["annotations"][2]["content"] == 'quote " and \\ slash'
    one = doc.select(F.explode("doc.annotations").alias("a")).select("a", annotation_from_json(annotation_to_json(F.col("a"))).alias("b"))
    assert all(r.a == r.b for r in one.collect())
    bad = spark.createDataFrame([("{}",), ("x",), ("[1]",)], "j STRING").select(
        document_from_json(F.col("j")).alias("d"), annotation_from_json(F.col("j")).alias("a")).collect()
    assert all(r.d is None and r.a is None for r in bad)


def test_annotators_from_definitions(spark):
    given = spark.createDataFrame([("b", None, 1, True, "x"), ("a", "own", 2, None, None), ("c", None, 3, False, "z")],
                                  "label STRING, host STRING, port INT, post_process BOOLEAN, path STRING")
    defs = A.annotator_defs(given, "shared", 2, 0)

    def asked(document, definition):
        return {"type": "text", "content": f"{definition.host}:{definition.port}/{definition.path} {document['document_id']}"}

    def first(doc):
        return F.from_json(F.to_json(F.struct(F.lit("text").alias("type"), F.upper(doc["extracted_text"]).alias("text"))), A.ANNOTATION)

    made = A.annotators_from_defs(defs, {"a": first}, {"b": asked, "c": asked}, "b,a")
    assert [(m.label, m.post_process, m.retry_count) for m in made] == [("a", False, 2), ("b", True, 2)]
    got = results(spark, ["text"], *made)
    assert (got["d0", "a"].annotation.text, got["d0", "b"].annotation.text) == ("TEXT", "shared:1/x d0")
    assert A.annotators_from_defs(defs.where("false")) == []
    with pytest.raises(ValueError, match="nothing is registered"):
        A.annotators_from_defs(defs, {"a": first})
    with pytest.raises(ValueError, match="twice"):
        A.annotators_from_defs(defs.unionByName(defs.withColumn("port", F.lit(9))), {}, dict.fromkeys("abc", asked))


def test_one_pause_a_round(monkeypatch):
    pauses = []
    monkeypatch.setattr(A.time, "sleep", pauses.append)
    bad = A.Annotator("bad", function=failing, retry_count=2, retry_pause_ms=500)
    slow = A.Annotator("slow", function=failing, retry_count=1, retry_pause_ms=2000)
    calls = []
    good = A.Annotator("good", function=calls.append)
    settled = A._call_in_rounds([bad, good, slow], [{"document_id": str(i)} for i in range(50)])
    assert pauses == [2.0, 1.0] and len(calls) == 50
    assert {settled[d, i][3] for d in range(50) for i in (0,)} == {3} and settled[7, 2][3] == 2 and settled[7, 1] == ("none", None, None, 1)
