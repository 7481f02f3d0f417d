"""Tables on disk, search view, batches and streams."""

import json

from pyspark.sql import functions as F

from foliary.functions.documents import document_record
from foliary.operators import tables as T
from foliary.operators.annotate import Annotator, run_state
from foliary.plans.batch import BatchSettings, run_batch
from foliary.plans.ingest import IngestSettings
from foliary.sources.feeds import stream_files
from foliary.sources.store import CorpusStore
from foliary.streaming.ingest import ingest_stream
from tests.test_ingest import OTHER, TEXT, event


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def view(spark, *rows):
    frame = spark.createDataFrame(list(rows), "id STRING, t STRING, u STRING, tenants ARRAY<STRING>")
    made = frame.select(document_record({}, document_id=F.col("id"), extracted_text=F.col("t"), uri=F.col("u")).alias("d"), "tenants")
    return made.select("d.*", "tenants")


def test_upsert_keeps_the_last_change(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "document_id STRING, v INT")
    changes = spark.createDataFrame([("a", 5, 1), ("a", 7, 3), ("a", 6, 2), ("c", 9, 1)], "document_id STRING, v INT, seq INT")
    assert sorted(map(tuple, T.upsert(table, changes).collect())) == [("a", 7), ("b", 2), ("c", 9)]


def test_tenants(spark):
    tenants = spark.createDataFrame([("t", "a"), ("s", "a")], "tenant STRING, doc_id STRING")
    more = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "b")], "tenant STRING, doc_id STRING")
    assert sorted(map(tuple, T.add_to_tenants(tenants, more).collect())) == [("s", "a"), ("t", "a"), ("t", "b")]
    assert {r.doc_id: r.tenants for r in T.tenants_by_document(tenants).collect()} == {"a": ["s", "t"]}


def test_search_view(spark):
    old = view(spark, ("a", "text", "uri", ["t"]), ("b", "x", None, None))
    sent = view(spark, ("a", None, "new", None), ("c", "fresh", None, None)).drop("tenants")
    after = {r.document_id: r for r in T.search_upsert(old, sent).collect()}
    assert (after["a"].extracted_text, after["a"].uri, after["a"].tenants) == ("text", "new", ["t"])
    assert (after["c"].extracted_text, after["b"].extracted_text) == ("fresh", "x")
    full = spark.createDataFrame([("a", ["z"])], "doc_id STRING, tenants ARRAY<STRING>")
    assert {r.document_id: r.tenants for r in T.search_set_tenants(old, full).collect()} == {"a": ["z"], "b": None}
    assert [r.document_id for r in T.search_get(old, full).collect()] == ["a"]


def feed(spark, events):
    return spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "seq BIGINT, doc_id STRING, value STRING")


EVENTS = [
    event("a", TEXT, tenants=["t"]), event("b", OTHER, labels=["x"]), ("bad", "{no json"),
    event("c", TEXT, genre="g", tenants=["s"]), event("b", "new text", labels=["y"]), event("d", ""),
    event("e", OTHER + " and some more words to make it another text altogether yes", reannotate=True),
    event("a", TEXT, tenants=["t"]), event("c", TEXT, genre="g"),
]
SETTINGS = BatchSettings(annotators=[Annotator("size", function=lambda d: {"type": "text", "content": str(len(d["extracted_text"]))})])


def state(store):
    corpus = {r.document_id: (r.extracted_text, sorted(r.labels), r.extracted_metadata.stated_genre, [a.label for a in r.annotations]) for r in store.corpus().collect()}
    tenants = sorted(map(tuple, store.tenant_docs().select("tenant", "doc_id").collect()))
    decisions = sorted((r.seq, r.outcome, r.duplicate_of, r.target_change, r.message) for r in store.read("decisions").collect())
    return corpus, tenants, decisions


def test_batch_repeat_and_stream_agree(spark, tmp_path):
    whole = CorpusStore(spark, str(tmp_path / "whole"))
    run_batch(feed(spark, EVENTS), whole, 0, at(), SETTINGS)
    corpus, tenants, decisions = state(whole)
    assert [d[1] for d in decisions] == ["NEW", "NEW", "DUPLICATE", "UPDATE", "ERROR", "NEW", "UPDATE", "DUPLICATE"]
    assert corpus["b"][1] == ["x", "y"] and corpus["a"][2] == "g"
    assert corpus["a"][3] == ["d", "s", "size"]
    assert tenants == [("s", "a"), ("t", "a")]
    assert [r.doc_id for r in whole.read("rejected").collect()] == ["bad"]
    topics = {r.topic: r["count"] for r in whole.read("notices").groupBy("topic").count().collect()}
    assert topics == {"corpus.updates": 6, "corpus.duplicates": 2, "corpus.dead-letters": 1}

    # The same batch again replaces what it wrote before.
    run_batch(feed(spark, EVENTS), whole, 0, at(), SETTINGS)
    assert state(whole) == (corpus, tenants, decisions)

    # In three micro-batches; only annotators run earlier, on documents as they were then.
    folder = tmp_path / "in"
    streamed = CorpusStore(spark, str(tmp_path / "streamed"))
    for first, last in ((0, 3), (3, 6), (6, 9)):
        feed(spark, EVENTS).where(f"seq >= {first} and seq < {last}").coalesce(1).write.mode("append").parquet(str(folder))
        source = stream_files(spark, str(folder))
        ingest_stream(source, streamed, str(tmp_path / "ckpt"), SETTINGS, processed_at=at).trigger(availableNow=True).start().awaitTermination()
    assert state(streamed) == (corpus, tenants, decisions)
    assert streamed.read("corpus", before=1).select("document_id").distinct().count() == 2
    compacted = streamed.compact(str(tmp_path / "compact"))
    assert compacted.corpus().count() == 3
    assert streamed.corpus(ids=spark.createDataFrame([("a",)], "document_id STRING")).count() == 1


def test_texts_and_view_do_not_depend_on_batches(spark, tmp_path):
    """Ids other than the key, split words, and several batches or one."""
    def doc(doc_id, words):
        return event(doc_id, words)
    texts = ["the zaffi rot near here and a CONFL ICT " * 2, "one zaffirot was seen by all of them today", "another zaffirot came to the old town hall",
             "later on a zaffi rot and one more Zaffi rot", "zaffi, that is what two of them say", "others say zaffi, as well here", "now zaffi rot stays as it is"]
    events = [doc(str(i), t) for i, t in enumerate(texts)]
    one, many = (CorpusStore(spark, str(tmp_path / n)) for n in ("one", "many"))
    whole = feed(spark, events)
    run_batch(whole, one, "all", at())
    for r in whole.collect():
        run_batch(spark.createDataFrame([r], whole.schema), many, f"event {r.seq}", at())
    def rows(store):
        return sorted((r.document_id, r.extracted_text, r.labels, sorted(r.tenants or [])) for r in store.search_view().collect())
    assert rows(one) == rows(many) and len(rows(one)) == 7
    stored = [r[1] for r in rows(one)]
    assert "CONFLICT" in stored[0] and "zaffi rot" in stored[0]  # nobody had used the word by then
    assert stored[3] == "later on a zaffirot and one more Zaffirot" and stored[6] == texts[6]  # the left part is a word by then
    few = CorpusStore(spark, str(tmp_path / "few"))
    for first, last in ((0, 2), (2, 4), (4, 7)):
        run_batch(whole.where(f"seq >= {first} and seq < {last}"), few, f"from {first}", at())
    assert rows(few) == rows(one)
    assert {r.word: r.docs for r in few.compact(str(tmp_path / "again")).read("lexicon").collect()}["zaffirot"] == 2
    assert {r.document_id for r in one.search_view(ids=spark.createDataFrame([("1",)], "document_id STRING")).collect()} == {"1"}


def test_failed_annotators_are_asked_again_by_later_batches(spark, tmp_path):
    """A service that fails on one document: the next batch, of other documents, asks it again and completes the run."""
    store = CorpusStore(spark, str(tmp_path / "runs"))

    def annotator(down):
        def call(document):
            if document["document_id"] in down:
                raise RuntimeError("down")
            return {"type": "text", "content": "seen"}
        return BatchSettings(ingest=IngestSettings(dedup=None), annotation_rounds=2,
                             annotators=[Annotator("size", function=call, retry_count=0)])

    def runs():
        rows = store.read("annotation_runs")
        return {r.doc_id: (r.done, r.failed, r.complete) for r in run_state(rows, 1).collect()}

    run_batch(feed(spark, [event("a", TEXT), event("b", OTHER), event("g", OTHER)]), store, "first", at(), annotator({"a", "g"}))
    assert runs() == {"a": (0, 1, False), "b": (1, 0, True), "g": (0, 1, False)}
    for _ in range(2):  # a repeated batch sees the runs as of its own start
        run_batch(feed(spark, [event("c", TEXT)]), store, "second", at(), annotator({"g"}))
        assert {r.doc_id: r.round for r in store.read("annotation_runs", 2).where("batch = 1").collect()} == {"a": 2, "c": 1, "g": 2}
    assert runs() == {"a": (1, 0, True), "b": (1, 0, True), "c": (1, 0, True), "g": (0, 1, False)}
    assert store.open_runs().count() == 0  # two batches asked about g: given up
    assert {r.document_id: [a.label for a in r.annotations][2:] for r in store.search_view().collect()} == {
        "a": ["size"], "b": ["size"], "c": ["size"], "g": []}
    written = {r.document_id for r in store.read("corpus").where("batch = 1").collect()}
    assert written == {"a", "c", "g"}
    assert {r.status for r in store.read("pipeline_status").where("batch = 1 and doc_id = 'a'").collect()} == {"SUCCESS"}


def test_lookup_opens_asked_buckets_and_batches_only(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "versions"))
    rows = view(spark, *[(f"d{i}", f"text {i}", "u0", None) for i in range(200)]).drop("tenants")
    store.append("corpus", rows, 0)
    store.append("corpus", rows.where("document_id < 'd2'").withColumn("uri", F.lit("u1")), 1)
    store.append("corpus", rows.where(F.lit(False)), 2)
    ids = spark.createDataFrame([("d1",), ("none",)], "document_id STRING")
    found = store.corpus(ids=ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [(r.document_id, r.uri) for r in found.collect()] == [("d1", "u1")] and "Window" not in plan
    (bucket,) = {r.bucket for r in store.stored().known(ids).collect()}
    assert "(bucket#" in plan and f" = {bucket})" in plan and " = 1)" in plan
    assert [r.uri for r in store.corpus(1, ids).collect()] == ["u0"] and store.corpus(0, ids).count() == 0
    assert store.corpus().where("uri = 'u1'").count() == rows.where("document_id < 'd2'").count()
    assert store.stored().known(ids.where("document_id = 'none'")).count() == 0


def test_parts_leave_what_they_do_not_set(spark):
    parts = spark.createDataFrame(
        [("a", "t", ["x"], 0), ("a", None, [], 1), ("a", None, None, 2), ("b", None, None, 1), ("c", "late", ["z"], 9)],
        "document_id STRING, t STRING, labels ARRAY<STRING>, batch BIGINT")
    got = {r.document_id: (r.t, r.labels) for r in T.merge_parts(parts, "batch").collect()}
    assert got == {"a": ("t", []), "b": (None, None), "c": ("late", ["z"])}


def test_empty_store(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "none"))
    assert store.corpus().count() == 0 and store.shingle_index().rows().count() == 0
    result = run_batch(feed(spark, EVENTS[:1]), store, 0, at(), BatchSettings(ingest=IngestSettings(dedup=None)))
    assert json.loads(store.read("notices").first().value)["document"]["document_id"] == "a"
    assert result.rejected.count() == 0


def test_stream_on_a_filled_store_keeps_its_rows(spark, tmp_path):
    filled = CorpusStore(spark, str(tmp_path / "filled"))
    settings = BatchSettings()
    run_batch(feed(spark, EVENTS[:1]), filled, "first", at(), settings)
    compacted = filled.compact(str(tmp_path / "compact"))
    folder = tmp_path / "more"
    feed(spark, [event("copy", TEXT)]).withColumn("seq", F.lit(100).cast("long")).coalesce(1).write.parquet(str(folder))
    source = stream_files(spark, str(folder))
    ingest_stream(source, compacted, str(tmp_path / "ckpt2"), settings, processed_at=at).trigger(availableNow=True).start().awaitTermination()
    assert [r.document_id for r in compacted.corpus().collect()] == ["a"]
    found = compacted.read("decisions").where("doc_id = 'copy'").first()
    assert (found.outcome, found.duplicate_of) == ("DUPLICATE", "a")
    assert compacted.number("a new origin") == 2 and compacted.number("a new origin") == 2
