"""Conversion of the input formats and envelopes."""

import json

import pytest
from pyspark.sql import functions as F

from foliary.functions import envelope as E
from foliary.functions import news as N
from foliary.operators.routing import read_events, route_formats
from foliary.sources.codes import LabelLookup, code_table, join_labels, read_code_tables
from foliary.sources.feeds import INGEST_TOPIC, kafka_options, layered

CODES = [
    ("region", "USA", "United States"), ("region", "BALKZ", "Balkan States"),
    ("industry", "i1300006", "Pipeline Transportation"), ("industry", "isptech", "Sports Technologies"),
    ("subject", "NCAT", "Content Types"),
]
NEWS = {
    "an": "A1", "title": "T", "snippet": "Short", "body": "Long", "byline": "By Ada Rowan",
    "publication_date": "1546387200000", "publication_datetime": "1546387200000",
    "modification_datetime": "1546434000000", "region_codes": ",usa,balkz,",
    "industry_codes": ",i1300006,isptech,", "subject_codes": "", "language_code": "en",
    "publisher_name": "publisher", "document_type": "article",
}


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def lookup(spark):
    return LabelLookup(code_table(spark.createDataFrame(CODES, "kind STRING, code STRING, label STRING")))


def convert(spark, documents, lookup=None, doc_id="k"):
    values = [(i, doc_id, json.dumps({"document": d})) for i, d in enumerate(documents)]
    events = spark.createDataFrame(values, "seq BIGINT, doc_id STRING, value STRING")
    parsed = E.parse_envelopes(events)
    rows = route_formats(parsed.select("seq", "doc_id", "document"), at(), lookup).orderBy("seq").collect()
    return rows


@pytest.mark.parametrize("byline,author", [
    ("by Author Name", "Author Name"), ("By Author Name", "Author Name"), ("BY Author Name", "Author Name"),
    ("by. Author Name", "Author Name"), ("by: Author Name", "Author Name"),
    ("Written by Author Name", "Author Name"), ("Abby Smith", "Abby Smith"), ("", ""), (None, ""),
    ("By \tAuthor Name \x01", "Author Name"),
])
def test_author(spark, byline, author):
    row = spark.createDataFrame([(byline,)], "b STRING").select(N.author(F.col("b")).alias("a")).first()
    assert row.a == author


def test_news_document(spark, lookup):
    [row] = convert(spark, [NEWS], lookup)
    doc, meta = row.doc, row.doc.extracted_metadata
    assert (row.format, row.error, row.target_id) == ("news", None, "k")
    assert (doc.document_id, doc.source_uri, doc.extracted_text) == ("k", "A1", "Short\nLong")
    assert (doc.capture_source, doc.content_type, meta.classification, meta.producer) == (
        "AutoCollection", "application/json", "UNCLASSIFIED", "Dow Jones")
    assert (str(meta.creation_date), str(meta.modification_date)) == ("2019-01-02", "2019-01-02")
    assert (meta.author, meta.description, meta.url, meta.subject, meta.creator) == ("Ada Rowan", "Short", "", "", "")
    assert {a.label: [f.value for f in a.facets] for a in doc.annotations} == {
        "factiva-regions": ["United States", "Balkan States"],
        "factiva-industries": ["Pipeline Transportation", "Sports Technologies"],
    }
    assert {a["class"] for a in doc.annotations} == {"static"}
    assert {a.version for a in doc.annotations} == {"1"}


def test_news_codes(spark, lookup):
    rows = convert(spark, [
        {"an": "x"}, {"an": "x", "region_codes": ",USA,none,"}, {"an": "x", "region_codes": ",usa,,usa,zz"},
    ], lookup)
    facets = [[[f.value for f in a.facets] for a in r.doc.annotations] for r in rows]
    # Upper-case input never matches; a list of unknown codes still gives an annotation.
    assert facets == [[], [[]], [["United States", "United States"]]]


def test_news_schema(spark):
    rows = convert(spark, [
        {"an": "x", "unlisted": "y"}, {"an": 5}, {"title": "no number"}, {"an": "x", "title": None},
        {"an": "x", "company_codes_occur_ticker_exchange": "ok"},
    ])
    assert [r.format for r in rows] == [None, None, None, None, "news"]
    assert rows[0].error == "unrecognised format"


def test_news_dates(spark):
    rows = convert(spark, [
        {**NEWS, "publication_datetime": ""}, {**NEWS, "publication_datetime": "soon"},
        {k: v for k, v in NEWS.items() if k != "publication_datetime"},
        {k: v for k, v in NEWS.items() if k != "publication_date"},
        {**NEWS, "modification_datetime": ""}, {**NEWS, "modification_datetime": "1.5"},
    ])
    assert [r.error for r in rows] == [None, "conversion failed", "conversion failed", None, None, "conversion failed"]
    assert [r.doc.extracted_metadata.creation_date is None for r in rows if r.doc] == [True, True, False]


def pulse(kind="crawl", **norm):
    return {"norm": {"body": "sample body", "author": "me", **norm}, "norm_attribs": {"type": kind}}


def test_pulse_documents(spark):
    crawl = {**pulse(url="https://u/1", timestamp="2021-09-15T23:30:00-05:00"), "meta": {"title": [{"results": ["First", "x"]}]}, "uid": 1}
    rows = convert(spark, [crawl, pulse("telegram_stream"), pulse("tweet_traptor", url="https://t/2")])
    assert [r.doc.capture_source for r in rows] == ["pulse_crawl", "pulse_telegram_stream", "pulse_tweet_traptor"]
    assert [r.doc.extracted_metadata.title for r in rows] == ["First", "", ""]
    assert [r.doc.source_uri for r in rows] == ["https://u/1", "", "https://t/2"]
    assert [str(r.doc.extracted_metadata.creation_date) for r in rows] == ["2021-09-15", "None", "None"]
    meta = rows[0].doc.extracted_metadata
    assert (meta.publisher, meta.author, meta.original_language, meta.producer, meta.doc_type) == ("me", "", "en", "Pulse", "crawl")


def test_pulse_failures(spark):
    rows = convert(spark, [
        {"norm": {"author": "a"}}, {"norm": {"body": "b", "author": 3}}, {"norm": {"body": "b"}},
        {"norm": {"body": "b"}, "norm_attribs": {}}, pulse(timestamp="yesterday"),
        {**pulse(), "meta": {"title": [{}]}}, {**pulse(), "meta": {"title": []}},
    ])
    assert [r.error for r in rows] == [
        "unrecognised format", "unrecognised format", "conversion failed", None, "conversion failed",
        "conversion failed", None,
    ]
    assert rows[3].doc.capture_source == "pulse_null"


def test_canonical_document(spark):
    sent = {
        "document_id": "own", "extracted_text": "hi", "labels": ["a", "a"], "timestamp": "2021-09-22T16:56:45.000Z",
        "extracted_metadata": {"CreationDate": "2021-09-15", "Title": "t", "Pages": 3},
        "annotations": [
            {"type": "tags", "label": "t", "version": "1", "content": [{"offset_start": 0, "offset_end": 2, "tag": "X", "score": 0.4}]},
            {"type": "genealogy", "label": "g", "version": "1", "class": "derived",
             "content": {"similar_documents": {"a": 0.5}, "similarity_matrix": [[1.0, 0.5]]}},
            {"type": "text", "label": "s", "version": "1", "content": "short"},
            {"type": "dictionary", "label": "d", "version": "1", "content": {"k": "v"}},
        ],
    }
    [row, empty] = convert(spark, [sent, {}])
    assert (row.format, row.target_id, row.doc.labels) == ("canonical", "own", ["a"])
    tags, genealogy, words, pairs = row.doc.annotations
    assert (tags.tags[0].offset_end, tags.tags[0].value, tags["class"]) == (2, None, None)
    assert genealogy.genealogy.similar_documents == {"a": 0.5}
    assert (words.text, pairs.dictionary) == ("short", {"k": "v"})
    assert row.doc.extracted_metadata.pages == 3
    assert empty.error == "unrecognised format"


def test_envelopes(spark):
    values = [
        '{"document": {"an": "x"}, "other": 1}',
        '{"metadata": null, "document": {}}',
        '{"metadata": {"genre": "", "labels": ["l", "l"], "reannotate": true}, "document": {}}',
        '{"metadata": {"genre": "g", "tenants": null, "source_uri": "u"}, "document": {}}',
        "{broken", '{"document": []}', '{"metadata": {}}', '{"metadata": {"tenants": "t"}, "document": {}}', "[1]", "null",
    ]
    events = spark.createDataFrame(list(enumerate(values)), "seq BIGINT, value STRING").withColumn("doc_id", F.lit("k"))
    accepted, rejected = read_events(events, at())
    assert sorted(r.seq for r in rejected.collect()) == [4, 5, 6, 7, 8, 9]
    got = {r.seq: r.overrides for r in accepted.collect()}
    assert got[0].asDict() == got[1].asDict() == {
        "labels": [], "source_uri": None, "tenants": [], "genre": "unspecified", "run_annotators": False}
    assert got[2].asDict() == {"labels": ["l"], "source_uri": None, "tenants": [], "genre": "unspecified", "run_annotators": True}
    assert (got[3].genre, got[3].tenants, got[3].source_uri) == ("g", [], "u")


def test_metadata_json_keeps_nulls(spark):
    row = spark.createDataFrame([('{"genre": "g"}',)], "t STRING").select(E.metadata_to_json(E.metadata_from_json(F.col("t"))).alias("j")).first()
    assert json.loads(row.j) == {"tenants": None, "source_uri": None, "labels": None, "genre": "g", "ingestion_system": None, "reannotate": None}


def test_code_tables_from_files(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes("USA,United States\nCURAC,Curaçao\nBAD,Some\xff".encode("utf-8")[:-2] + b"\xff")
    codes = read_code_tables(spark, {"region": str(tmp_path / "r.csv")})
    assert {(r.code, r.label) for r in codes.collect()} == {("usa", "United States"), ("curac", "Curaçao"), ("bad", "Some")}
    coded = spark.createDataFrame([("region", "usa"), ("region", "USA")], "kind STRING, code STRING")
    assert {(r.code, r.label) for r in join_labels(coded, codes).collect()} == {("usa", "United States"), ("USA", None)}
    with pytest.raises(ValueError):
        LabelLookup(codes, limit=2)


def test_code_tables_of_any_size(spark, lookup, monkeypatch):
    documents = [
        NEWS | {"subject_codes": ",ncat,ncat,none,", "region_codes": ",usa,"}, NEWS | {"subject_codes": ""}, {"x": 1}, NEWS]
    codes = code_table(spark.createDataFrame(CODES, "kind STRING, code STRING, label STRING"))

    def converted(labels):
        return [(r.seq, r.format, r.doc, r.error, r.target_id) for r in convert(spark, documents, labels)]

    want = converted(lookup)
    assert converted(codes) == want
    monkeypatch.setattr("foliary.sources.codes.LOOKUP_LIMIT", 1)
    assert converted(codes) == want


def test_kafka_options():
    options = kafka_options("h:9092", poll_size=200, shared={"startingOffsets": "latest", "a": "1"}, specific={"a": None})
    assert options == {"kafka.bootstrap.servers": "h:9092", "subscribe": INGEST_TOPIC, "maxOffsetsPerTrigger": "200", "startingOffsets": "latest"}
    assert layered({"x": 1}, None, {"x": 2}) == {"x": 2}
