"""One query per operator. Results are flat rows, so that any engine can compare them."""

from __future__ import annotations

from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import documents as D
from foliary.functions import envelope as E
from foliary.functions import news as N
from foliary.functions import pulse as P
from foliary.functions.language import learn_languages
from foliary.functions.text import detect_language, normalize_text
from foliary.operators import annotate as A
from foliary.operators import outputs as O
from foliary.operators import routing as R
from foliary.operators import tables as T
from foliary.operators.fold import change_log, fold_overrides
from foliary.operators.ligatures import DEFAULT_WORDS, ArrivalLexicon, Lexicon, repair_ligatures
from foliary.operators.neardup import NearDupSettings, copies_of, copy_lists, near_duplicates, shingle_sets
from foliary.plans import core as C
from foliary.plans.batch import BatchSettings
from foliary.plans.ingest import Decisions, IngestSettings, decide
from foliary.session import cut
from foliary.sources.codes import join_labels
from foliary.sources.feeds import stream_files
from foliary.sources.store import CorpusStore
from foliary.streaming.ingest import dedup_stream, ingest_stream

from workload import feed as W

_MEMO: dict = {}


def _memo(name: str, spark: SparkSession, sf_dir: str, build):
    """Frames several queries start from, written down once per session and data set."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def clear_memo() -> None:
    _MEMO.clear()


def joined(names: Column) -> Column:
    return F.array_join(F.array_sort(names), "|")


def text(value: Column) -> Column:
    return value.cast("string")


# --- shared inputs ----------------------------------------------------------------------------

def feed(spark, sf):
    return _memo("feed", spark, sf, lambda: W.feed(spark, sf))


def parsed(spark, sf):
    return E.parse_envelopes(feed(spark, sf))


def accepted(spark, sf):
    return _memo("accepted", spark, sf, lambda: R.read_events(
        feed(spark, sf), W.processed_at(), W.lookup(spark, sf), "detect"
    ))[0]


def corpus(spark, sf):
    return _memo("corpus", spark, sf, lambda: cut(W.stored_corpus(spark, sf)))


def tenants(spark, sf):
    return _memo("tenants", spark, sf, lambda: cut(W.stored_tenants(spark, sf)))


def decisions(spark, sf) -> Decisions:
    def build():
        index = cut(shingle_sets(W.stored_texts(spark, sf), NearDupSettings()))
        return decide(
            accepted(spark, sf), corpus(spark, sf), tenants(spark, sf), index, IngestSettings(detector="detect")
        )

    return _memo("decisions", spark, sf, build)


def documents(spark, sf):
    return W.spread(W.read(spark, sf, "documents"))


def all_ids(spark, sf):
    return documents(spark, sf).select(F.concat(F.lit("D"), text(F.col("doc_id"))).alias("doc_id"))


def stored_docs(spark, sf):
    """Stored documents as ``(doc_id, doc)``."""
    stored = corpus(spark, sf)
    return stored.select(F.col("document_id").alias("doc_id"), F.struct(*stored.columns).alias("doc"))


def archived(spark, sf):
    """All documents in their stored form as ``(doc_id, doc)``."""
    stored = _memo("archive", spark, sf, lambda: cut(W.archive(spark, sf)))
    return stored.select(F.col("document_id").alias("doc_id"), F.struct(*stored.columns).alias("doc"))


def ontologies(spark, sf):
    """An ontology per event type of a source's namesake user, versions by event: every source has
    as many versions as the events of the user with its number."""
    events = W.read(spark, sf, "events")
    return events.select(
        F.concat(F.lit("src"), text(F.col("user_id"))).alias("tenant"),
        F.concat("event_type", F.lit("-"), text(F.col("event_id"))).alias("id"),
        F.col("event_id").cast("int").alias("version"),
    )


# --- sources, envelopes, formats ----------------------------------------------------------------

def dim_codes(spark, sf):
    return W.codes(spark, sf)


def envelope_parse(spark, sf):
    m = F.col("metadata")
    return parsed(spark, sf).select(
        "seq", "doc_id", text(F.col("parsed")).alias("parsed"),
        joined(m["tenants"]).alias("tenants"), joined(m["labels"]).alias("labels"),
        m["genre"].alias("genre"), m["source_uri"].alias("source_uri"), text(m["reannotate"]).alias("reannotate"),
    )


def envelope_roundtrip(spark, sf):
    rows = parsed(spark, sf).where("parsed")
    back = E.metadata_from_json(E.metadata_to_json(F.col("metadata")))
    whole = E.envelope_to_json(F.col("metadata"), F.col("document"))
    again = E.parse_envelopes(rows.select("seq", "doc_id", back.alias("m"), whole.alias("value")))
    return again.select(
        "seq", text(F.col("parsed")).alias("parsed"),
        joined(F.col("m.tenants")).alias("tenants"), joined(F.col("metadata.labels")).alias("labels"),
        F.col("m.genre").alias("genre"), F.col("metadata.source_uri").alias("source_uri"),
        text(F.col("m.reannotate")).alias("reannotate"),
    )


def overrides(spark, sf):
    o = E.overrides_of(F.col("metadata"))
    rows = parsed(spark, sf).where("parsed").select("seq", o.alias("o"))
    return rows.select(
        "seq", joined(F.col("o.labels")).alias("labels"), joined(F.col("o.tenants")).alias("tenants"),
        F.col("o.source_uri").alias("source_uri"), F.col("o.genre").alias("genre"),
        text(F.col("o.run_annotators")).alias("run_annotators"),
    )


def validate_news(spark, sf):
    return parsed(spark, sf).where("parsed").select("seq", text(N.is_news("document")).alias("valid"))


def validate_pulse(spark, sf):
    return parsed(spark, sf).where("parsed").select("seq", text(P.is_pulse("document")).alias("valid"))


def _routed(spark, sf):
    return _memo("routed", spark, sf, lambda: cut(R.route_formats(
        cut(parsed(spark, sf)).where("parsed").select("seq", "doc_id", "document"),
        W.processed_at(), W.lookup(spark, sf),
    ).drop("document")))


def route_format(spark, sf):
    return _routed(spark, sf).select("seq", "doc_id", "format", "error", "target_id")


def _flat_document(rows: DataFrame) -> DataFrame:
    d, m = F.col("doc"), F.col("doc.extracted_metadata")
    return rows.select(
        "seq", d["document_id"].alias("document_id"), d["capture_source"].alias("capture_source"),
        d["content_type"].alias("content_type"), d["extracted_text"].alias("extracted_text"),
        d["source_uri"].alias("source_uri"), joined(d["labels"]).alias("labels"),
        text(m["creation_date"]).alias("creation_date"), text(m["modification_date"]).alias("modification_date"),
        m["author"].alias("author"), m["doc_type"].alias("doc_type"), m["description"].alias("description"),
        m["original_language"].alias("original_language"), m["classification"].alias("classification"),
        m["title"].alias("title"), m["publisher"].alias("publisher"), m["url"].alias("url"),
        text(m["pages"]).alias("pages"), m["producer"].alias("producer"),
        m["stated_genre"].alias("stated_genre"),
        F.array_join(F.transform(d["annotations"], lambda a: a["label"]), "|").alias("annotations"),
    )


def _converted(kind):
    def query(spark, sf):
        return _flat_document(_routed(spark, sf).where((F.col("format") == kind) & F.col("doc").isNotNull()))

    return query


def author_clean(spark, sf):
    return W.raw_documents(spark, sf).select("doc_id", N.author(F.col("byline")).alias("author"))


def epoch_dates(spark, sf):
    raw = W.raw_documents(spark, sf)
    rows = raw.select("doc_id", F.struct(
        F.col("stamp").alias("publication_date"), F.col("published").alias("publication_datetime"),
        F.when(F.col("shape") == "news_bad_date", "never").otherwise(F.col("modified")).alias("modification_datetime"),
    ).alias("n"))
    n = F.col("n")
    return rows.select(
        "doc_id",
        text(N.creation_date(n["publication_date"], n["publication_datetime"])).alias("creation"),
        text(N.epoch_date(n["modification_datetime"])).alias("modification"),
        text(N.bad_dates(n)).alias("bad"),
    )


def text_concat(spark, sf):
    return W.raw_documents(spark, sf).select(
        "doc_id", N.article_text(F.col("snippet"), F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 0, F.col("text"))).alias("text")
    )


def _codes_of(raw: DataFrame) -> Column:
    return F.struct(
        F.col("subjects").alias("subject_codes"), F.col("regions").alias("region_codes"),
        F.col("industries").alias("industry_codes"),
    )


def code_facets(spark, sf):
    raw = W.raw_documents(spark, sf)
    notes = N.code_facets(F.col("news"), W.lookup(spark, sf))
    rows = raw.select("doc_id", _codes_of(raw).alias("news")).select("doc_id", F.explode(notes).alias("a"))
    return rows.select(
        "doc_id", F.col("a.label").alias("annotation"), F.col("a.class").alias("class"),
        F.array_join(F.col("a.facets.value"), "|").alias("facets"),
    )


def code_join(spark, sf):
    raw = W.raw_documents(spark, sf)
    lists = F.array(*[
        F.struct(F.lit(kind).alias("kind"), N.code_list(F.col(column)).alias("codes"))
        for kind, column in (("subject", "subjects"), ("region", "regions"), ("industry", "industries"))
    ])
    coded = raw.select("doc_id", F.inline(lists)).select("doc_id", "kind", F.posexplode("codes").alias("pos", "code"))
    return join_labels(coded, W.codes(spark, sf)).select(
        "doc_id", "kind", F.col("pos").cast("bigint").alias("pos"), "code", "label"
    )


# --- text ---------------------------------------------------------------------------------------

def damaged(spark, sf):
    """Documents with extraction errors put into those that are labelled."""
    return documents(spark, sf).join(W.read(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id",
        F.when(F.col("quality").isNotNull(), F.concat(
            "text", F.lit(" dash － , soft­hyphen “and” a confl ict of staff ices, di ff erent")
        )).otherwise(F.col("text")).alias("text"),
    )


def text_normalize(spark, sf):
    return damaged(spark, sf).select("doc_id", normalize_text(F.col("text")).alias("text"))


def ligature_repair(spark, sf):
    texts = damaged(spark, sf)
    return repair_ligatures(texts, Lexicon(texts, 2, DEFAULT_WORDS))


def ligature_repair_in_order(spark, sf):
    """Each text with the words that two documents before it held."""
    texts = damaged(spark, sf).withColumn("seq", F.col("doc_id").cast("bigint"))
    lexicon = ArrivalLexicon(Lexicon(), texts)
    return repair_ligatures(texts, lexicon, seq_col="seq").select("doc_id", "text")


def language_id(spark, sf):
    return documents(spark, sf).select("doc_id", detect_language(F.col("text")).alias("language"))


def language_learned(spark, sf):
    """Every document's language by a model learned from three quarters of the labelled ones."""
    docs = W.read(spark, sf, "documents")
    held_out = F.pmod("doc_id", F.lit(4)) == 2
    model = learn_languages(docs.where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), model.detect(F.col("text")).alias("language"))


def language_agreement(spark, sf):
    """How many documents of each label the learned model agrees with, apart for those it has not seen."""
    labelled = W.read(spark, sf, "documents").select("doc_id", "lang").where("lang is not null")
    told = language_learned(spark, sf).join(labelled, "doc_id")
    right = (F.col("language") == F.col("lang")).cast("int")
    return told.groupBy("lang", "held_out").agg(
        F.count("*").alias("n"), F.sum(right).cast("bigint").alias("agreeing"),
        (100 * F.sum(right) >= 99 * F.count("*")).alias("good"))


def language_gate(spark, sf):
    return accepted(spark, sf).select("seq", "target_id", "lang", "error")


def preprocess_chain(spark, sf):
    steps = [
        lambda d: d.withColumn("doc", F.col("doc").withField("extracted_text", F.lower("doc.extracted_text"))),
        lambda d: d.withColumn("doc", F.col("doc").withField("labels", F.array_append("doc.labels", F.lit("seen")))),
    ]
    done = C.preprocess(archived(spark, sf), steps)
    return done.select("doc_id", F.col("doc.extracted_text").alias("text"), joined(F.col("doc.labels")).alias("labels"))


# --- lookups and merges ----------------------------------------------------------------------

def corpus_lookup(spark, sf):
    return T.find_documents(all_ids(spark, sf), corpus(spark, sf)).select(
        "doc_id", F.col("doc.extracted_text").alias("text"), F.col("doc.extracted_metadata.stated_genre").alias("genre")
    )


def corpus_exists(spark, sf):
    found = T.documents_exist(all_ids(spark, sf), corpus(spark, sf))
    return found.select("doc_id", text(F.col("stored")).alias("stored"))


def tenants_of_doc(spark, sf):
    return T.tenants_by_document(tenants(spark, sf)).select("doc_id", joined(F.col("tenants")).alias("tenants"))


def find_existing(spark, sf):
    found = T.find_existing(all_ids(spark, sf), corpus(spark, sf), tenants(spark, sf))
    return found.select(
        "doc_id", F.col("doc.source_uri").alias("source_uri"), joined(F.col("tenants")).alias("tenants")
    )


def _event_on_stored(spark, sf):
    """Every accepted event of a stored document with that document and its tenants."""
    events = accepted(spark, sf).where("error is null").select("seq", F.col("target_id").alias("doc_id"), "overrides", F.col("doc").alias("sent"))
    memberships = T.tenants_by_document(tenants(spark, sf))
    return events.join(stored_docs(spark, sf), "doc_id").join(memberships, "doc_id")


def merge_overrides(spark, sf):
    rows = _event_on_stored(spark, sf).select("seq", D.merge_overrides(F.col("doc"), F.col("overrides")).alias("doc"))
    return rows.select(
        "seq", joined(F.col("doc.labels")).alias("labels"), F.col("doc.source_uri").alias("source_uri"),
        F.col("doc.extracted_metadata.stated_genre").alias("genre"),
    )


def tenant_delta(spark, sf):
    return _event_on_stored(spark, sf).select(
        "seq", joined(D.tenant_delta(F.col("tenants"), F.col("overrides.tenants"))).alias("tenants")
    )


def needs_reannotate(spark, sf):
    return _event_on_stored(spark, sf).select(
        "seq", text(D.needs_reannotation(F.col("doc"), F.col("sent"))).alias("differs")
    )


def strip_derived(spark, sf):
    return archived(spark, sf).select(
        "doc_id", F.array_join(F.transform(D.only_static(F.col("doc.annotations")), lambda a: a["label"]), "|").alias("kept")
    )


def _event_messages(spark, sf):
    """One override message per row of ``events``."""
    k = F.get_json_object("props", "$.k")
    return W.read(spark, sf, "events").select(
        F.concat(F.lit("U"), text(F.col("user_id"))).alias("target_id"), F.col("event_id").alias("seq"),
        F.struct(
            F.array("event_type").alias("labels"),
            F.when(F.col("event_type") == "view", F.concat(F.lit("uri:"), k)).alias("source_uri"),
            F.array(F.concat(F.lit("tenant"), k)).alias("tenants"),
            F.when(F.col("event_type") == "purchase", "shop").when(F.col("event_type") == "error", "log")
            .otherwise("unspecified").alias("genre"),
            ((F.col("event_type") == "signup") & (F.col("value") > 15)).alias("run_annotators"),
        ).alias("overrides"),
    )


def fold_query(spark, sf):
    folded = fold_overrides(_event_messages(spark, sf))
    return folded.select(
        "target_id", joined(F.col("labels")).alias("labels"), joined(F.col("tenants")).alias("tenants"),
        "source_uri", "genre", text(F.col("run_annotators")).alias("run_annotators"), "last_seq",
    )


def change_log_query(spark, sf):
    messages = _event_messages(spark, sf)
    base = messages.select("target_id").distinct().select(
        "target_id", F.array(F.lit("view")).alias("labels"), F.array().cast("array<string>").alias("tenants"),
        F.lit(None).cast("string").alias("source_uri"), F.lit("unspecified").alias("genre"),
    )
    flags = ["new_labels", "new_tenants", "new_source_uri", "new_genre"]
    log = change_log(messages, base, stretch=1 << 10)
    return log.select("target_id", "seq", *[text(F.col(f)).alias(f) for f in flags], "change")


# --- duplicates and decisions -------------------------------------------------------------------

def _texts(spark, sf):
    return documents(spark, sf).select(F.col("doc_id").alias("seq"), "doc_id", "text")


def near_duplicates_query(spark, sf):
    found = near_duplicates(_texts(spark, sf))
    return found.select("doc_id", "first_duplicate", text(F.col("score")).alias("score"))


def near_duplicates_whole(spark, sf):
    found = near_duplicates(_texts(spark, sf), NearDupSettings(max_words=None))
    return found.select("doc_id", "first_duplicate")


def near_duplicate_turns(spark, sf):
    said = W.read(spark, sf, "conversations")
    # 10,000 numbers a conversation as in the SQL, more where a conversation is longer
    width = max(10_000, (said.agg(F.max("turn")).first()[0] or 0) + 1)
    number = F.col("conv_id").cast("bigint") * width + F.col("turn")
    turns = said.select(number.alias("seq"), number.alias("doc_id"), "text")
    return near_duplicates(turns).select("doc_id", "first_duplicate")


def copies_of_labelled(spark, sf):
    asked = W.read(spark, sf, "labels").where("quality = 1").select("doc_id")
    return copies_of(asked, _texts(spark, sf)).select("doc_id", "duplicate_id")


def duplicate_lists(spark, sf):
    """Whole lists of the documents whose id is divisible by 20, against all: as response and as status message."""
    asked = documents(spark, sf).where("doc_id % 20 = 0").select("doc_id")
    found = copy_lists(_texts(spark, sf)).lists(asked)
    hits = F.transform("duplicates", lambda d: F.struct(text(d).alias("doc_id"), F.lit(1).cast("decimal(3,2)").alias("score")))
    told = found.select(
        "doc_id", O.duplicate_response_json(hits).alias("json"),
        O.duplicate_status_message(text(F.col("doc_id")), F.transform("duplicates", lambda d: F.concat(F.lit("D"), text(d)))).alias("message"))
    back = O.duplicate_response_from_json(F.col("json")).getField("doc_id")
    return told.select("doc_id", F.size(back).cast("bigint").alias("n"), F.array_join(back, "|").alias("duplicates"), "message")


def ingest_outcome(spark, sf):
    return decisions(spark, sf).events.select(
        "seq", "doc_id", "target_id", "outcome", "duplicate_of", "target_change", "operation", "message",
        text(F.col("run_annotators")).alias("run_annotators"),
    )


def route_duplicates(spark, sf):
    changes = decisions(spark, sf).messages
    return changes.select(
        "target_id", "seq", joined(F.col("overrides.labels")).alias("labels"),
        F.col("overrides.genre").alias("genre"), "change",
    )


def _lexicon(spark, sf) -> Lexicon:
    return Lexicon(documents(spark, sf).select("doc_id", "text"))


def core_new(spark, sf):
    made = C.core_new(decisions(spark, sf).new_documents, _lexicon(spark, sf))
    return _flat_document(made.select("seq", "doc"))


def core_update(spark, sf):
    folded = fold_overrides(decisions(spark, sf).messages)
    done = C.core_update(stored_docs(spark, sf), folded)
    return done.select(
        "doc_id", joined(F.col("doc.labels")).alias("labels"), F.col("doc.source_uri").alias("source_uri"),
        F.col("doc.extracted_metadata.stated_genre").alias("genre"),
        F.array_join(F.transform(F.col("doc.annotations"), lambda a: a["label"]), "|").alias("annotations"),
    )


def corpus_upsert(spark, sf):
    changed = C.apply_decisions(decisions(spark, sf), _lexicon(spark, sf))
    after = C.corpus_after(corpus(spark, sf), changed)
    return after.select(
        "document_id", joined(F.col("labels")).alias("labels"), "source_uri",
        F.col("extracted_metadata.stated_genre").alias("genre"), "extracted_text",
    )


def tenant_add(spark, sf):
    return T.add_to_tenants(tenants(spark, sf), C.tenant_additions(decisions(spark, sf)))


# --- outputs ------------------------------------------------------------------------------------

def ontology_mapping(spark, sf):
    mapped = O.ontology_mappings(all_ids(spark, sf), tenants(spark, sf), ontologies(spark, sf))
    pairs = F.transform(F.col("ontologies"), lambda o: F.concat(o["tenant"], F.lit("="), o["id"]))
    return mapped.select("doc_id", joined(pairs).alias("ontologies"))


def notify_update(spark, sf):
    notices = O.update_notices(archived(spark, sf), W.archive_tenants(spark, sf), ontologies(spark, sf))
    j = lambda path: F.get_json_object("value", path)
    return notices.select(
        "key", j("$.document.document_id").alias("document_id"), j("$.document.extracted_text").alias("text"),
        j("$.document.extracted_metadata.stated_genre").alias("genre"),
        j("$.document.annotations[0].content").alias("first_content"),
        j("$.document.annotations[1].label").alias("second_label"),
        j("$.ontologies[0].id").alias("ontology"),
    )


def notify_annotation(spark, sf):
    notices = A.annotation_notices(_all_docs(spark, sf), _annotated(spark, sf), tenants(spark, sf), ontologies(spark, sf))
    return notices.select(
        "key", F.get_json_object("value", "$.document.annotations[0].label").alias("label"),
        F.get_json_object("value", "$.ontologies[0].id").alias("ontology"),
    )


def notify_duplicate(spark, sf):
    notices = O.duplicate_notices(decisions(spark, sf).events)
    return notices.groupBy("key", "value").agg(F.count("*").alias("n")).select(
        "key", F.get_json_object("value", "$.doc_id").alias("doc_id"),
        F.get_json_object("value", "$.duplicated_docs[0]").alias("duplicate"), "n",
    )


def dead_letters(spark, sf):
    letters = O.dead_letters(decisions(spark, sf).events, F.unix_millis(W.processed_at()))
    return letters.groupBy(*letters.columns).agg(F.count("*").alias("n"))


def error_rows(spark, sf):
    return O.error_rows(decisions(spark, sf).events)


def pipeline_status(spark, sf):
    rows = O.core_status(decisions(spark, sf).events, F.unix_millis(W.processed_at()))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def dup_status(spark, sf):
    rows = O.core_status(decisions(spark, sf).events, F.unix_millis(W.processed_at()))
    kept = rows.where("status = 'FAILURE' and stage = 'ingestion'")
    return kept.groupBy("doc_id", "message").agg(F.count("*").alias("n"))


def thin_view(spark, sf):
    thin = O.thin_view(archived(spark, sf))
    return thin.select("doc_id", F.posexplode("doc.annotations").alias("pos", "a")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("a.label").alias("label"), F.col("a.content").alias("content")
    )


def cdr_json(spark, sf):
    """JSON and back: the documents read from their own JSON."""
    made = O.cdr_json(_routed(spark, sf).where("doc is not null").select(F.col("seq").alias("doc_id"), "doc"))
    back = made.select(F.col("doc_id").alias("seq"), D.document_from_json(F.col("json")).alias("doc"))
    return _flat_document(back)


def dup_json(spark, sf):
    hits = F.array(F.struct(F.concat(F.lit("D"), text(F.col("first_duplicate"))).alias("doc_id"), F.col("score")))
    found = near_duplicates(_texts(spark, sf)).select("doc_id", O.duplicate_response_json(hits).alias("json"))
    back = found.select("doc_id", F.get(O.duplicate_response_from_json(F.col("json")), F.lit(0)).alias("hit"))
    return back.select("doc_id", F.col("hit.doc_id").alias("duplicate"), text(F.col("hit.score")).alias("score"))


# --- annotation and search view -----------------------------------------------------------------

def _given_defs(spark, sf):
    """One annotator definition per part brand; brands of large parts lack a host."""
    return W.read(spark, sf, "part").groupBy("p_brand").agg(
        F.max("p_size").alias("size"), F.min("p_partkey").alias("key")
    ).select(
        F.col("p_brand").alias("label"), F.when(F.col("size") < 50, F.concat(F.lit("host-"), text(F.col("size")))).alias("host"),
        F.col("key").cast("int").alias("port"), (F.col("size") < 40).alias("post_process"), F.lit("annotate").alias("path"),
    )


def annotator_defs(spark, sf):
    defs = A.annotator_defs(_given_defs(spark, sf), "shared", 6, 1000)
    return defs.select(
        "label", "host", F.col("port").cast("bigint").alias("port"), text(F.col("post_process")).alias("post_process"),
        "path", F.col("retry_count").cast("bigint").alias("retry_count"), "retry_pause_ms",
    )


def annotators_enabled(spark, sf):
    defs = A.annotator_defs(_given_defs(spark, sf), "shared", 6, 1000)
    return A.enabled_annotators(defs, "Brand#1,Brand#3,Brand#99").select("label", "host")


def _all_docs(spark, sf):
    """All documents as ``(doc_id, doc)``, and a blank one for each labelled document."""
    given = documents(spark, sf).select(F.concat(F.lit("D"), text(F.col("doc_id"))).alias("doc_id"), "text", "source", "lang")
    blank = W.read(spark, sf, "labels").select(
        F.concat(F.lit("B"), text(F.col("doc_id"))).alias("doc_id"), F.lit("").alias("text"), F.lit("blank").alias("source"), F.lit("und").alias("lang"),
    )
    return given.unionByName(blank).select("doc_id", D.document_record(
        {"title": F.col("source")}, document_id=F.col("doc_id"), extracted_text=F.col("text"), labels=F.array("lang"),
    ).alias("doc"))


def annotatable(spark, sf):
    return A.annotatable(_all_docs(spark, sf)).select("doc_id")


def annotation_queue(spark, sf):
    return A.annotation_queue(decisions(spark, sf).events).select("seq", "target_id")


def annotator_fanout(spark, sf):
    rows = A.fan_out(A.annotatable(_all_docs(spark, sf)), ["first-word", "shouts", "shape"])
    return rows.select("doc_id", "label", F.col("position").cast("bigint").alias("position"))


def _annotation(kind: str, **content: Column) -> Column:
    names = ["text", "dictionary", "tags", "facets", "genealogy", "translation"]
    return F.struct(
        F.lit(kind).alias("type"), F.lit("raw").alias("label"), F.lit("1").alias("version"),
        F.lit("derived").alias("class"), *[content.get(n, F.lit(None)).alias(n) for n in names],
    ).cast(D.ANNOTATION)


def first_word(doc: Column) -> Column:
    """Tags the first word of a text."""
    end = F.length(F.regexp_extract(doc["extracted_text"], r"^\S+", 0))
    tag = F.struct(
        F.lit(0).alias("offset_start"), end.alias("offset_end"), F.lit(None).cast("string").alias("value"),
        F.lit("FIRST").alias("tag"), F.lit(0.5).alias("score"),
    )
    return F.when(end > 0, _annotation("tags", tags=F.array(tag)))


def shouts(doc: Column) -> Column:
    """Words in capitals with an exclamation mark as facets; empty for calm texts."""
    found = F.array_distinct(F.regexp_extract_all(doc["extracted_text"], F.lit("([A-Z]+)!!"), F.lit(1)))
    return _annotation("facets", facets=F.transform(found, lambda w: F.struct(w.alias("value"), F.lit(None).cast("double").alias("score"))))


def shape(doc: Column) -> Column:
    """Line count as a dictionary, for texts of several lines."""
    lines = F.size(F.split(doc["extracted_text"], "\n"))
    return F.when(lines > 1, _annotation("dictionary", dictionary=F.create_map(F.lit("lines"), lines.cast("string"))))


COLUMN_ANNOTATORS = [
    A.Annotator("first-word", column=first_word, post_process=True),
    A.Annotator("shouts", column=shouts),
    A.Annotator("shape", column=shape),
]


def _annotated(spark, sf):
    return _memo("annotated", spark, sf, lambda: cut(A.annotate(_all_docs(spark, sf), COLUMN_ANNOTATORS)))


def annotate(spark, sf):
    return _annotated(spark, sf).select(
        "doc_id", "label", "status",
        F.coalesce(
            F.get("annotation.tags", F.lit(0))["value"], F.array_join("annotation.facets.value", "|"),
            F.element_at("annotation.dictionary", "lines"),
        ).alias("content"),
    )


def annotate_from_defs(spark, sf):
    """Annotators named after regions: definitions and the enabled list decide which of the registered ones run."""
    regions = W.read(spark, sf, "region").select(
        F.lower("r_name").alias("label"), F.lit(None).cast("string").alias("host"), F.col("r_regionkey").cast("int").alias("port"),
        (F.col("r_regionkey") == 0).alias("post_process"), F.lit("annotate").alias("path"))
    registered = {"africa": first_word, "america": shouts, "asia": shape, "europe": shape}
    made = A.annotators_from_defs(A.annotator_defs(regions, "shared", 6, 1000), registered, enabled="africa,america,asia")
    return A.annotate(_all_docs(spark, sf), made).select(
        "doc_id", "label", "status",
        F.coalesce(
            F.get("annotation.tags", F.lit(0))["value"], F.array_join("annotation.facets.value", "|"),
            F.element_at("annotation.dictionary", "lines"),
        ).alias("content"),
    )


def tag_values(spark, sf):
    """Tags over UTF-16 offsets behind a character outside the basic plane."""
    rows = documents(spark, sf).select("doc_id", F.concat(F.lit("😀 "), "text").alias("text"))
    end = F.length(F.regexp_extract("text", r"^\S+ (\S*)", 1)) + 3
    tags = F.array(
        F.struct(F.lit(0).alias("offset_start"), F.lit(2).alias("offset_end"), F.lit(None).cast("string").alias("value"), F.lit("E").alias("tag"), F.lit(1.0).alias("score")),
        F.struct(F.lit(3).alias("offset_start"), end.alias("offset_end"), F.lit(None).cast("string").alias("value"), F.lit("W").alias("tag"), F.lit(1.0).alias("score")),
    )
    filled = rows.select("doc_id", D.fill_tag_values(tags, F.col("text")).alias("tags"))
    return filled.select("doc_id", F.inline("tags")).select("doc_id", "tag", "value")


def annotation_relabel(spark, sf):
    named = D.relabel(F.col("a"), F.concat(F.lit("x-"), F.col("a.type")))
    rows = archived(spark, sf).select("doc_id", F.explode("doc.annotations").alias("a"))
    return rows.select("doc_id", F.col("a.label").alias("was"), named["label"].alias("label"), F.col("a.text").alias("text"))


def annotation_nonempty(spark, sf):
    """Content test on the result of every annotator before it is judged."""
    docs = A.annotatable(_all_docs(spark, sf))
    rows = F.array(*[F.struct(F.lit(a.label).alias("label"), a.column(F.col("doc")).alias("a")) for a in COLUMN_ANNOTATORS])
    return docs.select("doc_id", F.inline(rows)).where("a is not null").select("doc_id", "label", text(D.has_content(F.col("a"))).alias("kept"))


def annotation_complete(spark, sf):
    done = A.annotation_complete(_annotated(spark, sf), len(COLUMN_ANNOTATORS))
    return done.select("doc_id", "done", text(F.col("complete")).alias("complete"))


def _asked_in_batch(document: dict, refused: tuple[str, ...]) -> dict | None:
    """Callable annotator that fails on some languages, as a service does that is down for them."""
    if document["labels"][0] in refused:
        raise RuntimeError("not available")
    return count_words(document)


def annotation_runs(spark, sf):
    """Runs of all documents over three batches; each asks again where the last one failed, the third gives French up."""
    docs, rows, before = _all_docs(spark, sf), None, None
    for batch, refused in enumerate((("es", "fr"), ("fr",), ("fr",))):
        asking = docs.withColumn("asked", F.lit(None).cast("array<string>"))
        if before is not None:
            asking = docs.join(before.groupBy("doc_id").agg(F.collect_list("label").alias("asked")), "doc_id")
        asked = [A.Annotator("first", column=first_word), A.Annotator(
            "words", function=partial(_asked_in_batch, refused=refused), retry_count=0)]
        none = spark.createDataFrame([], A.OPEN_RUNS)
        made = cut(A.run_rows(A.annotate(asking, asked, "asked"), none if before is None else before))
        before = A.open_runs(made, 3)
        made = made.withColumn("batch", F.lit(batch))
        rows = made if rows is None else rows.unionByName(made)
    last = rows.where("label = 'words'").groupBy("doc_id").agg(F.max("round").cast("bigint").alias("rounds"))
    return A.run_state(rows, 2).join(last, "doc_id").select(
        "doc_id", "done", "failed", text(F.col("complete")).alias("complete"), "rounds")


def _with_annotations(spark, sf):
    return T.append_annotations(_all_docs(spark, sf).select("doc.*"), A.additions(_annotated(spark, sf)))


def annotation_append(spark, sf):
    return _with_annotations(spark, sf).select(
        F.col("document_id").alias("doc_id"),
        F.array_join(F.transform("annotations", lambda a: a["label"]), "|").alias("annotations"),
    )


def count_words(document: dict) -> dict:
    """Callable annotator: word count of texts of several lines as a dictionary; fails on texts in capitals."""
    body = document["extracted_text"]
    if body.upper() == body:
        raise ValueError("all capitals")
    if "\n" not in body:
        return None
    return {"type": "dictionary", "label": "raw", "version": "1", "class": "derived", "content": {"words": str(len(body.split()))}}


def annotate_retry(spark, sf):
    annotator = A.Annotator("words", function=count_words, retry_count=2, retry_pause_ms=0)
    return A.annotate(_all_docs(spark, sf), [annotator]).select(
        "doc_id", "status", F.col("attempts").cast("bigint").alias("attempts"),
        F.element_at("annotation.dictionary", "words").alias("words"), "error",
    )


def _search_view(spark, sf):
    return O.search_rows(stored_docs(spark, sf), tenants(spark, sf))


def search_get(spark, sf):
    ids = W.read(spark, sf, "labels").where("quality = 1").select(F.concat(F.lit("D"), text(F.col("doc_id"))).alias("doc_id"))
    return T.search_get(_search_view(spark, sf), ids).select("document_id", "source_uri", joined(F.col("tenants")).alias("tenants"))


def search_upsert(spark, sf):
    sent = accepted(spark, sf).where(f"error is null and seq < {W.RESEND}").select("doc.*")
    after = T.search_upsert(_search_view(spark, sf), sent)
    return after.select(
        "document_id", "capture_source", "source_uri", "content_type", "extracted_text", joined(F.col("tenants")).alias("tenants")
    )


def search_annotation(spark, sf):
    bare = _search_view(spark, sf).withColumn("annotations", F.when(F.col("extracted_metadata.original_language") == "en", F.col("annotations")))
    after = T.search_add_annotations(bare, A.additions(_annotated(spark, sf)))
    return after.select("document_id", F.array_join(F.transform("annotations", lambda a: a["label"]), "|").alias("annotations"))


def search_tenants(spark, sf):
    full = T.tenants_by_document(T.add_to_tenants(tenants(spark, sf), C.tenant_additions(decisions(spark, sf))))
    after = T.search_set_tenants(_search_view(spark, sf), full)
    return after.select("document_id", joined(F.col("tenants")).alias("tenants"))


def search_parts(spark, sf):
    """All documents in the view, then new labels of the labelled ones, then new addresses of those in English, bare."""
    store = CorpusStore(spark, f"{_landing(spark, 'parts')}/store")
    first = W.archive(spark, sf).withColumn(
        "tenants", F.array(F.regexp_replace("source_uri", "^file:///", ""), F.lit("archive")))
    store.append("search_parts", T.search_part(first, F.lit(True)), 0)
    whole = store.read("search_parts", 1).drop("batch", "bucket")
    none = F.lit(None)
    labelled = W.read(spark, sf, "labels").select(F.concat(F.lit("D"), text(F.col("doc_id"))).alias("document_id")).distinct()
    seen = whole.join(labelled, "document_id", "left_semi").withColumns(
        {"labels": F.array(F.lit("seen")), "source_uri": none, "tenants": none})
    moved = whole.where("extracted_metadata.original_language = 'en'").withColumns(
        {"source_uri": F.concat(F.lit("moved:"), "source_uri"), "annotations": F.slice("annotations", 1, 0), "labels": none})
    for batch, rows in enumerate((seen, moved), 1):
        store.append("search_parts", T.search_part(rows, F.lit(False)), batch)
    return store.search_view().select(
        "document_id", joined(F.col("labels")).alias("labels"), "source_uri", "extracted_text",
        F.size("annotations").cast("bigint").alias("notes"), joined(F.col("tenants")).alias("tenants"),
    )


def corpus_versions(spark, sf):
    """All documents in three versions of a store; the labelled ones looked up by id, as of each batch."""
    store = CorpusStore(spark, f"{_landing(spark, 'versions')}/store")
    stored = archived(spark, sf).select("doc.*")
    ids = W.read(spark, sf, "labels").select(F.concat(F.lit("D"), text(F.col("doc_id"))).alias("document_id")).distinct()
    second = stored.join(ids, "document_id", "left_semi").withColumn("source_uri", F.lit("second"))
    third = stored.where("extracted_metadata.original_language = 'en'").withColumn("source_uri", F.lit("third"))
    for batch, rows in enumerate((stored, second, third)):
        store.append("corpus", rows, batch)
    found = [store.corpus(b, ids).select("document_id", "source_uri", F.lit(b).cast("bigint").alias("before")) for b in (1, 2, 3)]
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- streaming ------------------------------------------------------------------------------

def _land_and_drain(rows: DataFrame, folder: str, start) -> None:
    """Let the rows land in two halves of arrival order and run the stream after each."""
    middle = rows.agg(F.expr("percentile_approx(seq, 0.5, 100)")).first()[0]
    for half in (rows.where(F.col("seq") <= middle), rows.where(F.col("seq") > middle)):
        half.write.mode("append").parquet(folder)
        start().trigger(availableNow=True).start().awaitTermination()


def _landing(spark: SparkSession, name: str) -> str:
    """A folder of its own next to the session's checkpoints, for the streams' files."""
    from foliary.session import checkpoint_dir

    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def stream_ingest(spark, sf):
    """The feed as a stream into an empty store; result: its decisions."""
    root = _landing(spark, "ingest")
    store, labels = CorpusStore(spark, f"{root}/store"), W.lookup(spark, sf)
    settings = BatchSettings(ingest=IngestSettings(detector="detect"))

    def start():
        events = stream_files(spark, f"{root}/in", files_per_trigger=1_000_000)
        return ingest_stream(
            events, store, f"{root}/checkpoint", settings, labels, processed_at=W.processed_at
        )

    _land_and_drain(feed(spark, sf), f"{root}/in", start)
    return store.read("decisions").select(
        "seq", "doc_id", "target_id", "outcome", "duplicate_of", "target_change", "message"
    )


def stream_dedup(spark, sf):
    """Documents as a stream; result: those with an earlier near copy."""
    root = _landing(spark, "dedup")
    texts = _texts(spark, sf).select("seq", text(F.col("doc_id")).alias("doc_id"), "text")
    store = CorpusStore(spark, f"{root}/store")

    def start():
        return dedup_stream(
            spark.readStream.schema(texts.schema).parquet(f"{root}/in"), store, f"{root}/checkpoint"
        )

    _land_and_drain(texts, f"{root}/in", start)
    return store.read("decisions").select("doc_id", F.col("duplicate_of").alias("first_duplicate"))


QUERIES = {
    "dim_codes": dim_codes,
    "envelope_parse": envelope_parse,
    "envelope_roundtrip": envelope_roundtrip,
    "overrides": overrides,
    "validate_news": validate_news,
    "validate_pulse": validate_pulse,
    "route_format": route_format,
    "news_to_cdr": _converted("news"),
    "pulse_to_cdr": _converted("pulse"),
    "canonical_to_cdr": _converted("canonical"),
    "author_clean": author_clean,
    "epoch_dates": epoch_dates,
    "text_concat": text_concat,
    "code_facets": code_facets,
    "code_join": code_join,
    "text_normalize": text_normalize,
    "ligature_repair": ligature_repair,
    "ligature_repair_in_order": ligature_repair_in_order,
    "language_id": language_id,
    "language_learned": language_learned,
    "language_agreement": language_agreement,
    "language_gate": language_gate,
    "preprocess_chain": preprocess_chain,
    "corpus_lookup": corpus_lookup,
    "corpus_exists": corpus_exists,
    "tenants_of_doc": tenants_of_doc,
    "find_existing": find_existing,
    "merge_overrides": merge_overrides,
    "tenant_delta": tenant_delta,
    "needs_reannotate": needs_reannotate,
    "strip_derived": strip_derived,
    "fold_overrides": fold_query,
    "change_log": change_log_query,
    "near_duplicates": near_duplicates_query,
    "near_duplicates_whole_text": near_duplicates_whole,
    "near_duplicate_turns": near_duplicate_turns,
    "copies_of": copies_of_labelled,
    "duplicate_lists": duplicate_lists,
    "ingest_outcome": ingest_outcome,
    "route_duplicates": route_duplicates,
    "core_new": core_new,
    "core_update": core_update,
    "corpus_upsert": corpus_upsert,
    "tenant_add": tenant_add,
    "ontology_mapping": ontology_mapping,
    "notify_update": notify_update,
    "notify_annotation": notify_annotation,
    "notify_duplicate": notify_duplicate,
    "dead_letters": dead_letters,
    "error_rows": error_rows,
    "pipeline_status": pipeline_status,
    "dup_status": dup_status,
    "thin_view": thin_view,
    "cdr_json": cdr_json,
    "dup_json": dup_json,
    "annotator_defs": annotator_defs,
    "annotators_enabled": annotators_enabled,
    "annotatable": annotatable,
    "annotation_queue": annotation_queue,
    "annotator_fanout": annotator_fanout,
    "annotate": annotate,
    "annotate_from_defs": annotate_from_defs,
    "annotate_retry": annotate_retry,
    "tag_values": tag_values,
    "annotation_relabel": annotation_relabel,
    "annotation_nonempty": annotation_nonempty,
    "annotation_complete": annotation_complete,
    "annotation_runs": annotation_runs,
    "annotation_append": annotation_append,
    "search_get": search_get,
    "search_upsert": search_upsert,
    "search_annotation": search_annotation,
    "search_tenants": search_tenants,
    "search_parts": search_parts,
    "corpus_versions": corpus_versions,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
}
