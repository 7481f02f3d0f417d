"""An ingest feed made of whole tables, in Spark and as SQL.

Every row of ``documents`` becomes one event. The source of a document says in which format it
arrives; some of one source's arrive as broken JSON. Events of another source have a key of their own, not their document's id. Labelled documents arrive a second
time with other overrides. Documents labelled toxic are stored beforehand.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions.documents import document_record
from foliary.schemas import ANNOTATION
from foliary.session import among, land
from foliary.sources.codes import LabelLookup, code_table

RESEND = 1_000_000_000_000
PROCESSED_MS = 1704067200000

SHAPE = """
    CASE WHEN source = 'src19' AND lang IN ('en', 'fr') THEN 'broken'
         WHEN source IN ('src0','src1','src2','src3','src4','src5') THEN 'news'
         WHEN source IN ('src6','src7','src8','src9','src10') THEN 'pulse'
         WHEN source IN ('src11','src12','src13','src14','src15') THEN 'canonical'
         WHEN source = 'src16' THEN 'news_extra'
         WHEN source = 'src17' THEN 'news_bad_date'
         WHEN source = 'src18' THEN 'pulse_no_type'
         ELSE 'other' END
"""
BYLINE = """
    CASE lang WHEN 'en' THEN 'By Writer ' || CAST(doc_id AS VARCHAR(20))
              WHEN 'fr' THEN 'Report WRITTEN bY: Writer ' || source || ' '
              WHEN 'de' THEN 'Abby Smith'
              WHEN 'es' THEN '' END
"""
SNIPPET = "CASE WHEN quality = 1 THEN 'Notice from ' || source END"
STAMP = "CAST(1500000000000 + n_chars * 86400000 AS VARCHAR(20))"
PUBLISHED = f"CASE WHEN lang = 'de' THEN '' ELSE {STAMP} END"
MODIFIED = f"CASE WHEN quality IS NOT NULL THEN {STAMP} END"
SUBJECTS = "',' || source || ',zzz,' || source || ',' || lang || ','"
REGIONS = """
    CASE WHEN quality IS NULL THEN ',NATION_1,'
         ELSE ',nation_' || CAST(quality AS VARCHAR(9)) || ',nation_' || CAST(toxic AS VARCHAR(9)) || ',' END
"""
INDUSTRIES = """
    CASE lang WHEN 'es' THEN NULL WHEN 'fr' THEN '' ELSE ',brand#' || substr(source, 4) || ',nope,' END
"""
KIND = "CASE lang WHEN 'en' THEN 'crawl' WHEN 'fr' THEN 'telegram_stream' ELSE 'tweet_traptor' END"
URL = "CASE WHEN quality IS NOT NULL THEN 'https://example.org/' || CAST(doc_id AS VARCHAR(20)) END"
TIMESTAMP = """
    CASE lang WHEN 'en' THEN '2021-09-15T23:30:00-05:00'
              WHEN 'fr' THEN '2021-09-16T00:30:00.250Z'
              WHEN 'de' THEN NULL
              ELSE '2021-03-01T01:00:00+09:00' END
"""
TITLE = "CASE WHEN toxic IS NOT NULL THEN lang || ' ' || source END"
GENRE = "CASE lang WHEN 'en' THEN 'news' WHEN 'fr' THEN '' WHEN 'de' THEN 'unspecified' END"

# Shared by both engines; Spark's VARCHAR(n) cast in expressions is spelt STRING.
_COLUMNS = {
    "shape": SHAPE, "byline": BYLINE, "snippet": SNIPPET, "stamp": STAMP, "published": PUBLISHED,
    "modified": MODIFIED, "subjects": SUBJECTS, "regions": REGIONS, "industries": INDUSTRIES,
    "kind": KIND, "link": URL, "written": TIMESTAMP, "heading": TITLE, "genre": GENRE,
}


def _spark_sql(expression: str) -> str:
    return re.sub(r"VARCHAR\(\d+\)", "STRING", expression)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a table that comes in few pieces to every core; one in as many pieces or more stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels and the field values of their feed message."""
    return _with_values(spread(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))


def _toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those labelled toxic; texts of the others are not joined to anything."""
    labels = read(spark, sf_dir, "labels")
    toxic = among(read(spark, sf_dir, "documents"), labels.where("toxic = 1"), "doc_id")
    return _with_values(toxic, labels).where("toxic = 1")


def _with_values(documents: DataFrame, labels: DataFrame) -> DataFrame:
    docs = documents.join(labels, "doc_id", "left")
    return docs.select("*", *[F.expr(_spark_sql(sql)).alias(name) for name, sql in _COLUMNS.items()])


def document_json(docs: DataFrame) -> Column:
    """The ``document`` object of a feed message as a variant."""
    d = docs
    news = {
        "an": F.concat(F.lit("AN"), d["doc_id"].cast("string")), "publisher_name": d["source"],
        "title": d["heading"], "language_code": d["lang"], "document_type": F.lit("article"),
        "byline": d["byline"], "snippet": d["snippet"], "body": d["text"],
        "publication_date": d["stamp"], "publication_datetime": d["published"],
        "modification_datetime": d["modified"], "subject_codes": d["subjects"],
        "region_codes": d["regions"], "industry_codes": d["industries"],
    }

    def obj(fields: dict[str, Column]) -> Column:
        return F.struct(*[value.alias(key) for key, value in fields.items()])

    norm = obj({"body": d["text"], "author": d["source"], "url": d["link"], "timestamp": d["written"]})
    meta = F.when(
        d["heading"].isNotNull(),
        obj({"title": F.array(obj({"results": F.array(d["heading"])}))}),
    )
    canonical = {
        "document_id": _doc_key(d["doc_id"]), "capture_source": F.lit("ManualCuration"),
        "content_type": F.lit("text/plain"), "extracted_text": d["text"],
        "source_uri": F.concat(F.lit("file:///"), d["source"]),
        "timestamp": F.lit("2021-09-22T16:56:45.000Z"), "labels": F.array(d["lang"]),
        "extracted_metadata": obj({
            "CreationDate": F.lit("2021-09-15"), "Title": d["heading"], "OriginalLanguage": d["lang"],
            "Pages": d["n_chars"], "StatedGenre": F.lit("essay"),
        }),
        "annotations": F.from_json(F.concat(
            F.lit('[{"type":"tags","label":"t1","version":"1","class":"derived","content":'
                  '[{"offset_start":0,"offset_end":4,"tag":"X","score":0.5}]},'
                  '{"type":"facets","label":"f1","version":"1","class":"static","content":[{"value":"'),
            d["lang"], F.lit('","score":0.25}]}]'),
        ), "variant"),
    }
    return (
        F.when(d["shape"] == "news", F.to_json(obj(news)))
        .when(d["shape"] == "news_extra", F.to_json(obj({**news, "headline": d["lang"]})))
        .when(d["shape"] == "news_bad_date", F.to_json(obj({**news, "publication_datetime": F.lit("tomorrow")})))
        .when(d["shape"] == "pulse", F.to_json(obj({
            "norm": norm, "norm_attribs": obj({"type": d["kind"]}), "meta": meta, "uid": d["doc_id"],
        })))
        .when(d["shape"] == "pulse_no_type", F.to_json(obj({"norm": norm, "meta": meta})))
        .when(d["shape"] == "canonical", F.to_json(obj(canonical)))
        .otherwise(F.to_json(obj({"title": d["lang"], "size": d["n_chars"], "text": d["text"]})))
    )


def _doc_key(doc_id: Column) -> Column:
    return F.concat(F.lit("D"), doc_id.cast("string"))


#: The key of an event; the canonical documents of one source go by another id than their key.
KEY_SQL = "CASE WHEN source = 'src12' THEN 'K' ELSE 'D' END || CAST(doc_id AS VARCHAR(20))"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events ``(seq, doc_id, value)``, written down once like a landed feed."""
    docs = raw_documents(spark, sf_dir)
    quality = F.when(F.col("quality").isNotNull(), F.array(
        F.concat(F.lit("quality"), F.coalesce(F.col("quality").cast("string"), F.lit("?"))),
        F.concat(F.lit("toxic"), F.col("toxic").cast("string")),
    ))
    metadata = F.when(
        ~((F.col("lang") == "es") & F.col("quality").isNull()),
        F.struct(
            F.array("source", "lang").alias("tenants"), F.col("link").alias("source_uri"),
            quality.alias("labels"), F.col("genre"), F.lit("feed").alias("ingestion_system"),
            (F.col("toxic") == 1).alias("reannotate"),
        ),
    )
    again = F.struct(
        F.array(F.col("source"), F.lit("review")).alias("tenants"),
        F.array(F.concat(F.lit("quality"), F.coalesce(F.col("quality").cast("string"), F.lit("?")))).alias("labels"),
        F.lit("revised").alias("genre"), (F.col("toxic") == 1).alias("reannotate"),
    )
    body = document_json(docs)

    def envelope(metadata: Column) -> Column:
        prefix = F.coalesce(F.concat(F.lit('"metadata":'), F.to_json(metadata), F.lit(",")), F.lit(""))
        return F.concat(F.lit("{"), prefix, F.lit('"received":1,"document":'), body, F.lit("}"))

    def event(seq: Column, metadata: Column) -> Column:
        value = F.when(F.col("shape") == "broken", F.concat(F.lit('{"document": '), F.col("text"))).otherwise(envelope(metadata))
        return F.struct(seq.alias("seq"), F.expr(_spark_sql(KEY_SQL)).alias("doc_id"), value.alias("value"))

    first = F.array(event(F.col("doc_id"), metadata))
    second = F.array(event(F.col("doc_id") + RESEND, again))
    # both from one pass over the texts
    return land(docs.select(F.inline(F.when(F.col("quality").isNotNull(), F.concat(first, second)).otherwise(first))))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code table made of sources (subjects), nations (regions) and brands (industries)."""
    subjects = read(spark, sf_dir, "documents").select(
        F.lit("subject").alias("kind"), F.upper("source").alias("code"),
        F.concat(F.lit("Source "), "source").alias("label"),
    )
    regions = read(spark, sf_dir, "nation").select(
        F.lit("region").alias("kind"), F.col("n_name").alias("code"), F.initcap("n_name").alias("label")
    )
    industries = read(spark, sf_dir, "part").select(
        F.lit("industry").alias("kind"), F.col("p_brand").alias("code"),
        F.concat(F.col("p_brand"), F.lit(" goods")).alias("label"),
    )
    return code_table(subjects.unionByName(regions).unionByName(industries).distinct())


def lookup(spark: SparkSession, sf_dir: str) -> LabelLookup:
    return LabelLookup(codes(spark, sf_dir))


def processed_at() -> Column:
    return F.timestamp_millis(F.lit(PROCESSED_MS))


def stored_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus table: the documents labelled toxic, as an earlier batch would have left them."""
    return _stored_form(_toxic_documents(spark, sf_dir))


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in their stored form."""
    return _stored_form(raw_documents(spark, sf_dir))


def _stored_form(docs: DataFrame) -> DataFrame:
    stored = document_record(
        {"title": F.col("heading"), "original_language": F.col("lang"), "stated_genre": F.lit("archive")},
        document_id=_doc_key(F.col("doc_id")), capture_source=F.lit("Archive"),
        extracted_text=F.col("text"), source_uri=F.concat(F.lit("file:///"), F.col("source")),
        timestamp=processed_at(), labels=F.array(F.lit("stored"), F.concat(F.lit("quality"), F.coalesce(F.col("quality").cast("string"), F.lit("?")))),
        annotations=F.array(*[_note(cls) for cls in ("derived", "static")]),
    )
    return docs.select(stored.alias("doc")).select("doc.*")


def _note(cls: str) -> Column:
    """A text annotation naming the document's language."""
    wire = F.struct(
        F.lit("text").alias("type"), F.lit(f"note-{cls}").alias("label"), F.lit("1").alias("version"),
        F.lit(cls).alias("class"), F.col("lang").alias("text"),
    )
    rest = ["dictionary", "tags", "facets", "genealogy", "translation"]
    return F.struct(
        *[wire[f].alias(f) for f in ("type", "label", "version", "class", "text")],
        *[F.lit(None).alias(f) for f in rest],
    ).cast(ANNOTATION)


def stored_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memberships of the stored documents: their source and the archive."""
    return _memberships(_toxic_documents(spark, sf_dir))


def archive_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memberships of all documents."""
    return _memberships(raw_documents(spark, sf_dir))


def _memberships(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.explode(F.array(F.col("source"), F.lit("archive"))).alias("tenant"), _doc_key(F.col("doc_id")).alias("doc_id")
    )


def stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, doc_id, text)`` behind the shingle index of the stored documents."""
    return _toxic_documents(spark, sf_dir).select(
        F.col("doc_id").alias("seq"), _doc_key(F.col("doc_id")).alias("doc_id"), "text"
    )


# --- the same in SQL ----------------------------------------------------------------------------

def _j(**fields: str) -> str:
    """JSON object without its null members."""
    return "json_merge_patch('{}', json_object(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + "))"


_NEWS = dict(
    an="'AN' || doc_id", publisher_name="source", title="heading", language_code="lang",
    document_type="'article'", byline="byline", snippet="snippet", body="text",
    publication_date="stamp", publication_datetime="published", modification_datetime="modified",
    subject_codes="subjects", region_codes="regions", industry_codes="industries",
)
_NORM = _j(body="text", author="source", url="link", timestamp="written")
_META = "CASE WHEN heading IS NOT NULL THEN json_object('title', [json_object('results', [heading])]) END"

RAW_SQL = "raw AS (SELECT d.*, l.quality, l.toxic, " + ", ".join(
    f"{sql} AS {name}" for name, sql in _COLUMNS.items()
) + " FROM documents d LEFT JOIN labels l USING (doc_id))"

# One row per event that has a readable envelope, its document as JSON.
FEED_SQL = RAW_SQL + f""",
bodies AS (SELECT *, CASE shape
    WHEN 'news' THEN {_j(**_NEWS)}
    WHEN 'news_extra' THEN {_j(**_NEWS, headline="lang")}
    WHEN 'news_bad_date' THEN {_j(**{**_NEWS, "publication_datetime": "'tomorrow'"})}
    WHEN 'pulse' THEN {_j(norm=_NORM, norm_attribs="json_object('type', kind)", meta=_META, uid="doc_id")}
    WHEN 'pulse_no_type' THEN {_j(norm=_NORM, meta=_META)}
    WHEN 'canonical' THEN {_j(
        document_id="'D' || doc_id", capture_source="'ManualCuration'", content_type="'text/plain'",
        extracted_text="text", source_uri="'file:///' || source",
        timestamp="'2021-09-22T16:56:45.000Z'", labels="[lang]",
        extracted_metadata="json_object('CreationDate', '2021-09-15', 'Title', heading, "
                           "'OriginalLanguage', lang, 'Pages', n_chars, 'StatedGenre', 'essay')",
    )}
    ELSE json_object('title', lang, 'size', n_chars, 'text', text) END AS body
  FROM raw WHERE shape <> 'broken'),
events_in AS (
  SELECT doc_id AS seq, {KEY_SQL} AS doc_id, doc_id AS n, body, shape,
    CASE WHEN lang = 'es' AND quality IS NULL THEN [] ELSE [source, lang] END AS tenants,
    CASE WHEN quality IS NULL THEN [] ELSE ['quality' || quality, 'toxic' || toxic] END AS labels,
    CASE WHEN lang = 'es' AND quality IS NULL THEN NULL ELSE link END AS source_uri,
    CASE WHEN lang = 'en' THEN 'news' ELSE 'unspecified' END AS genre,
    coalesce(toxic = 1, false) AS run_annotators
  FROM bodies
  UNION ALL
  SELECT doc_id + {RESEND}, {KEY_SQL}, doc_id, body, shape,
    list_distinct([source, 'review']), ['quality' || quality], NULL, 'revised', toxic = 1
  FROM bodies WHERE quality IS NOT NULL)"""
