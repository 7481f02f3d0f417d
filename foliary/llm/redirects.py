"""URL filter with redirect equivalence, in DataFrame operations only.

Rules judge a url by its host and path; the longest fitting rule wins. Redirects and canonical links make
urls aliases of each other: a block decision reaches every url of its connected component, unless a rule of
its own allows a url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.components import components
from foliary.llm.frames import column, write_and_read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_key(url: Column) -> Column:
    """The name under which equal urls meet: without scheme, default port, fragment and ``utm_`` fields.

    Null for null urls and urls without ``://``.
    """
    query = F.regexp_extract(_rest(url), "^[^?#]*\\?([^#]*)", 1)
    fields = F.filter(F.split(query, "&"), lambda f: ~f.startswith("utm_") & (f != ""))
    rest = F.concat(F.regexp_replace(host_of(url), ":(80|443)$", ""), path_of(url))
    return F.when(F.locate("://", url) > 0, F.when(
        F.size(fields) > 0, F.concat(rest, F.lit("?"), F.array_join(fields, "&"))).otherwise(rest))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``(verdict, host, path, rule)`` from ``("allow" | "block", "host/path")``."""
    rows = [(verdict, host, slash + path, rule) for verdict, rule in rules for host, slash, path in [rule.partition("/")]]
    return spark.createDataFrame(rows, "verdict string, host string, path string, rule string")


def judge(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` for the distinct places that a rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest wins; of equal
    rules that allow and block, the allowing one. Every host is looked up under each of its suffixes, so
    the work does not grow with hosts x rules.
    """
    own = places.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "rule", "verdict")
    met = own.withColumn("suffix", F.explode(suffixes)).join(named, "suffix").where(F.expr("startswith(path, prefix)"))
    rank = F.struct(F.length("rule"), F.col("rule"), F.col("verdict") == "allow")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(source, target)`` urls from canonical links and meta refreshes, comments and scripts left out.

    Relative targets are resolved against the page's host and folder (dot segments are kept as they are).
    Pages without url or html, and targets of other kinds than web addresses, give no rows.
    """
    page, text = column(pages, url), column(pages, html)
    own = pages.select(page.alias("source"), text.alias("html")).where(
        page.contains("://") & text.rlike("(?i)canonical|refresh"))
    clean = F.regexp_replace("html", "(?is)<!--.*?-->|<script\\b.*?</script\\s*>", "")
    tags = own.select("source", F.explode(F.regexp_extract_all(clean, F.lit("(?is)<(?:link|meta)\\b[^>]*>"), F.lit(0))).alias("tag"))
    value = "\\s*=\\s*[\"']?\\s*"
    link = F.col("tag").rlike(f"(?is)^<link\\b.*\\brel{value}canonical\\b")
    meta = F.col("tag").rlike(f"(?is)^<meta\\b.*\\bhttp-equiv{value}refresh\\b")
    found = F.when(link, F.regexp_extract("tag", "(?is)\\bhref\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>\"']+))", 0)).when(
        meta, F.regexp_extract("tag", "(?is)\\burl\\s*=\\s*['\"]?([^'\">]*)", 0))
    target = F.trim(F.regexp_replace(F.regexp_replace(found, "(?is)^(?:href|url)\\s*=\\s*|[\"']", ""), "(?i)&amp;", "&"))
    links = tags.select("source", target.alias("href")).where("href is not null and href != ''")
    scheme = F.expr("substring_index(source, '://', 1)")
    site = F.concat(scheme, F.lit("://"), host_of(F.col("source")))
    path = path_of(F.col("source"))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    href = F.col("href")
    whole = (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(site, path, href))
        .when(href.startswith("#") | href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(site, folder, href)))
    return links.select("source", whole.alias("target")).where("target is not null")


def judge_pages(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str = "html",
) -> DataFrame:
    """``pages`` (all columns) with ``host``, ``path``, ``rule``, ``verdict`` and ``alias_of``.

    ``redirects`` adds ``(source, target)`` urls to the links found in the pages. Without a fitting rule
    the verdict is block if a url of the component is blocked by a rule, else allow; ``alias_of`` is the
    component's least key, null for urls without aliases. A null url, or one without ``://``, has an empty
    host and path and no aliases. Columns of the new names are replaced, repeated rows stay, and empty
    tables give empty results.
    """
    names = ("host", "path", "rule", "verdict", "alias_of")
    edges = page_links(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    ends = edges.select(url_key(F.col("source")).alias("a"), url_key(F.col("target")).alias("b"), "source", "target")
    ends = write_and_read(ends.where("a is not null and b is not null and a != b").distinct(), "links")
    alias = components(ends.select("a", "b"))
    urls = ends.select(F.col("a").alias("key"), F.col("source").alias("link")).unionAll(ends.select("b", "target")).distinct()
    places = urls.select("key", host_of(F.col("link")).alias("host"), path_of(F.col("link")).alias("path"))
    seeds = places.join(judge(places, rules), ["host", "path"]).where("verdict = 'block'").select(F.col("key").alias("node"))
    blocked = alias.join(seeds.distinct(), "node").select("root").distinct().withColumn("blocked", F.lit(True))
    state = alias.join(blocked, "root", "left").select(F.col("node").alias("__key"), F.col("root").alias("alias_of"), "blocked")
    # the pages' own columns stand aside under names of their own, so no column of theirs can clash
    taken = {n.lower() for n in names}
    kept = {c: f"__c{i}" for i, c in enumerate(pages.columns) if c.lower() not in taken}
    page = column(pages, url)
    own = pages.select(*[column(pages, c).alias(n) for c, n in kept.items()], host_of(page).alias("host"),
                       path_of(page).alias("path"), url_key(page).alias("__key"))
    judged = own.join(judge(own, rules).withColumnRenamed("verdict", "ruled"), ["host", "path"], "left")
    judged = judged.join(state, "__key", "left")
    verdict = F.coalesce("ruled", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(*[F.col(n).alias(c) for c, n in kept.items()], "host", "path", "rule", verdict.alias("verdict"), "alias_of")
