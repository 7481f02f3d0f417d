"""Decisions, core processing and outputs of a batch."""

import json

import pytest
from pyspark.sql import functions as F

from foliary.functions.documents import document_record, needs_reannotation, only_static, tenant_delta
from foliary.operators import outputs as O
from foliary.operators.fold import change_log, fold_overrides, previous_values
from foliary.operators.ligatures import Lexicon
from foliary.operators.routing import read_events
from foliary.plans import core as C
from foliary.plans.ingest import IngestSettings, decide
from foliary.schemas import CORPUS, TENANT_DOCS

TEXT = "one two three four five six seven eight nine ten eleven twelve"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def event(doc_id, text, **metadata):
    return doc_id, json.dumps({"metadata": metadata or None, "document": {
        "document_id": doc_id, "extracted_text": text,
        "annotations": [
            {"type": "text", "label": "d", "version": "1", "class": "derived", "content": "x"},
            {"type": "text", "label": "s", "version": "1", "class": "static", "content": "y"},
        ],
    }})


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def stored(spark, *docs):
    """Corpus and memberships of documents (id, text, tenants)."""
    if not docs:
        return spark.createDataFrame([], CORPUS), spark.createDataFrame([], TENANT_DOCS)
    rows = spark.createDataFrame([(d, t) for d, t, _ in docs], "id STRING, t STRING")
    corpus = rows.select(document_record(
        {"stated_genre": F.lit("unspecified")}, document_id=F.col("id"), extracted_text=F.col("t"),
        source_uri=F.lit("u"), labels=F.array(F.lit("label-3")),
    ).alias("doc")).select("doc.*")
    tenants = spark.createDataFrame([(t, d) for d, _, ts in docs for t in ts], TENANT_DOCS)
    return corpus, tenants


def run(spark, events, *docs, index=None, **settings):
    frame = spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "seq BIGINT, doc_id STRING, value STRING")
    settings = IngestSettings(**settings)
    accepted, _ = read_events(frame, at(), detector=settings.detector)
    corpus, tenants = stored(spark, *docs)
    decisions = decide(accepted, corpus, tenants, index, settings)
    return decisions, corpus, tenants


def outcomes(decisions):
    return [(r.outcome, r.duplicate_of, r.target_change) for r in decisions.events.orderBy("seq").collect()]


def test_new_update_noop(spark):
    d, _, _ = run(spark, [
        event("a", TEXT), event("a", "changed " + OTHER), event("a", TEXT, labels=["l"]),
        event("a", TEXT, labels=["l"]), event("a", TEXT, reannotate=True), event("a", TEXT, tenants=["t"]),
        event("a", TEXT, tenants=["t"]), event("a", TEXT, genre="g"), event("a", TEXT, genre="g"), event("a", TEXT),
    ])
    assert [o for o, _, _ in outcomes(d)] == [
        "NEW", "NOOP", "UPDATE", "NOOP", "UPDATE", "UPDATE", "NOOP", "UPDATE", "NOOP", "UPDATE"]


def test_stored_document(spark):
    d, _, _ = run(spark, [event("a", OTHER, labels=["label-3"]), event("a", OTHER, tenants=["1", "3"])], ("a", TEXT, ["1", "2"]))
    assert [o for o, _, _ in outcomes(d)] == ["NOOP", "UPDATE"]


def test_duplicate_routes_its_overrides(spark):
    d, corpus, _ = run(spark, [event("a", TEXT), event("b", TEXT, labels=["x"], genre="g"), event("c", TEXT, genre="g"), event("b", TEXT)])
    assert outcomes(d) == [("NEW", None, None), ("DUPLICATE", "a", "UPDATE"), ("DUPLICATE", "a", "NOOP"), ("DUPLICATE", "a", "UPDATE")]
    [doc] = C.apply_decisions(d, Lexicon()).collect()
    assert (doc.document_id, doc.labels, doc.extracted_metadata.stated_genre) == ("a", ["x"], "unspecified")
    assert {r.key: json.loads(r.value) for r in O.duplicate_notices(d.events.where("seq = 1")).collect()} == {
        "b": {"doc_id": "b", "duplicated_docs": ["a"]}}
    status = {(r.doc_id, r.stage, r.status, r.message) for r in O.core_status(d.events.where("seq = 1"), F.lit(5)).collect()}
    assert status == {
        ("b", "ingestion", "FAILURE", "b duplicates: a"), ("a", "ingestion", "SUCCESS", ""), ("a", "core-processing", "SUCCESS", "")}


def test_duplicate_of_a_rejected_copy(spark):
    long = [f"w{i}" for i in range(36)]
    first, second, third = list(long), list(long), list(long)
    second[0] = "x"
    third[0], third[35] = "x", "y"
    long_d = [event("a", " ".join(first)), event("b", " ".join(second)), event("c", " ".join(third))]
    d, _, _ = run(spark, long_d)
    # c is like b (rejected) but too far from a: it is rejected for a text that is not stored.
    rows = d.events.orderBy("seq").collect()
    assert [(r.outcome, r.duplicate_of, r.message) for r in rows] == [
        ("NEW", None, None), ("DUPLICATE", "a", None), ("DUPLICATE", "b", "original not stored")]


def test_own_earlier_copy_is_no_duplicate(spark):
    from foliary.operators.neardup import NearDupSettings, shingle_sets

    seen = spark.createDataFrame([(1, "a", TEXT)], "seq BIGINT, doc_id STRING, text STRING")
    d, _, _ = run(spark, [event("a", TEXT, tenants=["t"])], index=shingle_sets(seen, NearDupSettings()))
    assert outcomes(d) == [("NEW", None, None)]
    assert d.events.first().run_annotators
    assert [(r.tenant, r.doc_id) for r in C.tenant_additions(d).collect()] == [("t", "a")]


def test_errors(spark):
    d, _, _ = run(spark, [
        ("k", '{"document": {}}'), event("a", ""), event("e", "le chat et la souris dans une maison avec des amis"),
    ], detector="always_english")
    rows = d.events.orderBy("seq").collect()
    assert [(r.outcome, r.operation, r.message) for r in rows] == [
        ("ERROR", "ingestion", "unrecognised format"),
        ("ERROR", "deduplication", "deduplication failed - no text"), ("NEW", None, None)]
    letters = O.dead_letters(d.events, F.lit(7)).collect()
    assert {(r.doc_id, r.operation, r.timestamp) for r in letters} == {("k", "ingestion", 7), ("a", "deduplication", 7)}
    gated, _, _ = run(spark, [event("e", "le chat et la souris dans une maison avec des amis")], detector="detect")
    assert gated.events.first().message == "fra is not supported for: e"


def test_without_dedup(spark):
    d, _, _ = run(spark, [event("a", TEXT), event("b", TEXT), event("c", "")], dedup=None)
    assert [o for o, _, _ in outcomes(d)] == ["NEW", "NEW", "NEW"]


def test_core_processing(spark):
    d, corpus, tenants = run(
        spark, [event("n", "dash － confl ict " + OTHER, tenants=["t"]), event("a", OTHER, reannotate=True, labels=["1", "2"], source_uri="new")],
        ("a", TEXT, ["1"]))
    docs = {r.document_id: r for r in C.apply_decisions(d, Lexicon()).collect()}
    assert docs["n"].extracted_text.startswith("dash - conflict alpha")
    assert [a.label for a in docs["n"].annotations] == ["d", "s"]
    assert (docs["a"].extracted_text, docs["a"].source_uri, docs["a"].labels) == (TEXT, "new", ["label-3", "1", "2"])
    after = C.corpus_after(corpus, C.apply_decisions(d, Lexicon()))
    assert after.count() == 2


def test_update_strips_derived_annotations(spark):
    d, corpus, _ = run(spark, [event("a", TEXT), event("a", TEXT, reannotate=True)])
    [doc] = C.apply_decisions(d, Lexicon()).collect()
    assert [a.label for a in doc.annotations] == ["s"]


def test_preprocessors_run_in_order(spark):
    frame = spark.createDataFrame([("a", 1)], "doc_id STRING, n INT")
    steps = [lambda x: x.withColumn("n", F.col("n") + 1), lambda x: x.withColumn("n", F.col("n") * 10)]
    assert C.preprocess(frame, steps).first().n == 20
    assert C.preprocess(frame).first().n == 1


def test_tenant_delta_and_reannotation(spark):
    row = spark.sql("SELECT array('1','2') a, array('1','3') b, array('2') c").select(
        tenant_delta(F.col("a"), F.col("b")).alias("x"), tenant_delta(F.col("a"), F.col("c")).alias("y")).first()
    assert (sorted(row.x), row.y) == (["1", "2", "3"], [])
    corpus, _ = stored(spark, ("a", TEXT, []))
    doc = corpus.select(F.struct(*corpus.columns).alias("d"))
    same = doc.select(
        needs_reannotation(F.col("d"), F.col("d")).alias("no"),
        needs_reannotation(F.col("d"), F.col("d").withField("extracted_text", F.lit("z"))).alias("yes"),
        needs_reannotation(F.col("d"), F.col("d").withField("extracted_metadata.title", F.lit("z"))).alias("title"),
        F.size(only_static(F.col("d.annotations"))).alias("n")).first()
    assert (same.no, same.yes, same.title, same.n) == (False, True, True, 0)


def test_update_notice(spark):
    corpus, tenants = stored(spark, ("a", TEXT, ["t", "u", "none"]))
    docs = corpus.select(F.col("document_id").alias("doc_id"), F.struct(*corpus.columns).alias("doc"))
    ontologies = spark.createDataFrame([("t", "o1", 1), ("t", "o2", 2), ("u", "o3", 1)], "tenant STRING, id STRING, version INT")
    [notice] = O.update_notices(docs, tenants, ontologies).collect()
    value = json.loads(notice.value)
    assert notice.key == "a"
    assert value["ontologies"] == [{"tenant": "t", "id": "o2"}, {"tenant": "u", "id": "o3"}]
    assert value["document"]["extracted_text"] == TEXT


def messages(spark, rows):
    return spark.createDataFrame(
        rows, "target_id STRING, seq BIGINT, overrides STRUCT<labels: ARRAY<STRING>, source_uri: STRING, "
        "tenants: ARRAY<STRING>, genre: STRING, run_annotators: BOOLEAN>")


def test_fold(spark):
    folded = fold_overrides(messages(spark, [
        ("a", 1, (["x"], "u1", ["t"], "g1", False)), ("a", 3, (["x", "y"], None, [], "g3", False)),
        ("a", 2, ([], "u2", ["s"], "g2", True)),
    ])).first()
    assert (folded.labels, folded.tenants, folded.source_uri, folded.genre, folded.run_annotators, folded.last_seq) == (
        ["x", "y"], ["s", "t"], "u2", "g3", True, 3)


@pytest.mark.parametrize("stretch", [1, 3, 1 << 20])
def test_change_log_in_stretches(spark, stretch):
    """The two-step comparison gives what one pass in order gives, however long the stretches."""
    import random

    rng = random.Random(stretch)
    rows = [
        (rng.choice("ab"), seq, (rng.sample(["l", "m"], rng.randint(0, 1)), rng.choice([None, None, "u", "v"]),
         rng.sample(["t"], rng.randint(0, 1)), rng.choice(["g", "h"]), False))
        for seq in range(40)
    ]
    base = spark.createDataFrame(
        [(t, ["l"], [], None, "g") for t in "ab"],
        "target_id STRING, labels ARRAY<STRING>, tenants ARRAY<STRING>, source_uri STRING, genre STRING")
    got = {(r.target_id, r.seq): r.change for r in change_log(messages(spark, rows), base, stretch).collect()}
    state = {t: [{"l"}, set(), None, "g"] for t in "ab"}
    for target, seq, (labels, uri, tenants, genre, _) in rows:
        before = state[target]
        after = [before[0] | set(labels), before[1] | set(tenants), uri or before[2], genre]
        assert got[target, seq] == ("NOOP" if after == before else "UPDATE")
        state[target] = after
    flat = spark.createDataFrame([("a", s, v) for s, v in enumerate([None, "p", None, "q"])], "k STRING, seq BIGINT, v STRING")
    assert [r.prev_v for r in previous_values(flat, "k", ["v"], stretch).orderBy("seq").collect()] == [None, None, "p", "p"]


def test_duplicate_response_json(spark):
    hits = "array(named_struct('doc_id','1','score',cast(1 as decimal(3,2))))"
    row = spark.sql(f"SELECT {hits} h, slice({hits}, 1, 0) e").select(
        O.duplicate_response_json(F.col("h")).alias("h"), O.duplicate_response_json(F.col("e")).alias("e")).first()
    assert json.loads(row.h) == {"duplicated_docs": [{"doc_id": "1", "score": 1.0}]}
    assert row.e == "{}"
    back = spark.createDataFrame([(row.h,), ("{}",), ("{bad",), ("[]",)], "j STRING").select(
        O.duplicate_response_from_json(F.col("j")).alias("d")).collect()
    assert [None if r.d is None else [x.doc_id for x in r.d] for r in back] == [["1"], [], None, None]
