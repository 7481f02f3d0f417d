"""News-feed documents: a flat JSON object of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.schemas import ANNOTATION, FACET

# The keys a news document may carry.
NEWS_KEYS = [
    "action", "an", "art", "body", "byline", "company_codes", "company_codes_about",
    "company_codes_about_ticker_exchange", "company_codes_association",
    "company_codes_association_ticker_exchange", "company_codes_lineage",
    "company_codes_lineage_ticker_exchange", "company_codes_occur",
    "company_codes_occur_ticker_exchange", "company_codes_relevance",
    "company_codes_relevance_ticker_exchange", "company_codes_ticker_exchange", "copyright",
    "credit", "currency_codes", "dateline", "document_type", "industry_codes",
    "ingestion_datetime", "language_code", "market_index_codes", "modification_date",
    "modification_datetime", "person_codes", "publication_date", "publication_datetime",
    "publisher_name", "region_codes", "region_of_origin", "section", "snippet", "source_code",
    "source_name", "subject_codes", "title", "word_count",
]
# Constants of a converted news document.
CAPTURE_SOURCE = "AutoCollection"
CLASSIFICATION = "UNCLASSIFIED"
CONTENT_TYPE = "application/json"
PRODUCER = "Dow Jones"
FACET_LABELS = {
    "subject": "factiva-subjects",
    "region": "factiva-regions",
    "industry": "factiva-industries",
}
FACET_VERSION = "1"
BYLINE_PREFIX = r"^.*\b(b|B)(y|Y)\b(.|:)?\s{1,}"

NEWS_JSON = "STRUCT<" + ", ".join(
    f"{key}: STRING" for key in (
        "an", "publication_date", "publication_datetime", "modification_datetime", "snippet",
        "body", "byline", "document_type", "language_code", "title", "publisher_name",
        "subject_codes", "region_codes", "industry_codes",
    )
) + ">"


def is_news(document: str) -> Column:
    """True for an object that has ``an``, only listed keys, and only string values."""
    entries = F.expr(f"try_variant_get({document}, '$', 'map<string, variant>')")
    allowed = F.array(*[F.lit(key) for key in NEWS_KEYS])
    return F.coalesce(
        F.map_contains_key(entries, "an")
        & (F.size(F.array_except(F.map_keys(entries), allowed)) == 0)
        & F.forall(F.map_values(entries), lambda v: F.call_function("schema_of_variant", v) == "STRING"),
        F.lit(False),
    )


def news_fields(document: str) -> Column:
    return F.expr(f"try_variant_get({document}, '$', '{NEWS_JSON}')")


def strip_controls(text: Column) -> Column:
    """Trim every leading and trailing character up to U+0020."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def author(byline: Column) -> Column:
    """Name in a byline: all up to the last whole word "by" goes; "" for none."""
    cleaned = strip_controls(F.regexp_replace(byline, BYLINE_PREFIX, ""))
    return F.when(F.length(byline) > 0, cleaned).otherwise("")


DAY_MS = 86_400_000


def epoch_date(millis: Column) -> Column:
    """UTC date of an epoch-milliseconds string; null when it is no whole number or out of range."""
    whole = F.when(millis.rlike(r"^[+-]?\d+$"), millis.try_cast("bigint"))
    days = (whole - F.pmod(whole, F.lit(DAY_MS))) / DAY_MS
    return F.date_from_unix_date(days.try_cast("int"))


def creation_date(publication_date: Column, publication_datetime: Column) -> Column:
    wanted = publication_date.isNotNull() & (publication_datetime != "")
    return F.when(wanted, epoch_date(publication_datetime))


def bad_dates(news: Column) -> Column:
    """True when a date is asked for but cannot be read: the document cannot be converted."""
    published = news.getField("publication_datetime")
    modified = news.getField("modification_datetime")
    no_creation = news.getField("publication_date").isNotNull() & (
        published.isNull() | ((published != "") & epoch_date(published).isNull())
    )
    no_modification = F.coalesce(modified != "", F.lit(False)) & epoch_date(modified).isNull()
    return no_creation | no_modification


def article_text(snippet: Column, body: Column) -> Column:
    """Snippet and body, a line break between them; the one that exists if only one does."""
    return F.coalesce(F.concat(snippet, F.lit("\n"), body), body, snippet)


def code_list(codes: Column) -> Column:
    """Codes of a comma-framed list in order, repeats kept, empty ones dropped."""
    return F.filter(F.split(codes, ","), lambda code: code != "")


def code_keys(news: Column) -> Column:
    """All codes of a news document as ``kind/code`` keys."""
    def one(kind: str) -> Column:
        keys = F.transform(code_list(news.getField(f"{kind}_codes")), lambda code: F.concat(F.lit(f"{kind}/"), code))
        return F.coalesce(keys, F.array().cast("array<string>"))

    return F.concat(*[one(kind) for kind in FACET_LABELS])


def facet_annotation(kind: str, facets: Column) -> Column:
    """Static facet annotation of one code kind."""
    return F.struct(
        F.lit("facets").alias("type"),
        F.lit(FACET_LABELS[kind]).alias("label"),
        F.lit(FACET_VERSION).alias("version"),
        F.lit("static").alias("class"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("map<string,string>").alias("dictionary"),
        F.lit(None).cast("array<struct<offset_start:int,offset_end:int,value:string,tag:string,score:double>>").alias("tags"),
        facets.cast(f"array<{FACET}>").alias("facets"),
        F.lit(None).cast("struct<similar_documents:map<string,double>,similarity_matrix:array<array<double>>>").alias("genealogy"),
        F.lit(None).cast("string").alias("translation"),
    ).cast(ANNOTATION)


def code_facets(news: Column, labels: Column) -> Column:
    """Facet annotations of a news document.

    ``labels`` is the label lookup, ``map<string, string>`` keyed ``kind/code``. A missing or empty
    code list gives no annotation; a list of unknown codes gives one without facets. Keys of the
    lookup are lower case and the codes are looked up as written.
    """
    def one(kind: str) -> Column:
        codes = news.getField(f"{kind}_codes")
        known = F.filter(
            F.transform(
                code_list(codes),
                lambda code: labels.getItem(F.concat(F.lit(f"{kind}/"), code)),
            ),
            lambda label: label != "",
        )
        facets = F.transform(
            known,
            lambda label: F.struct(label.alias("value"), F.lit(None).cast("double").alias("score")),
        )
        return F.when(F.length(codes) > 0, facet_annotation(kind, facets))

    return F.array_compact(F.array(*[one(kind) for kind in FACET_LABELS]))
