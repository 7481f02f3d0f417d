"""One query per operator with production parameters, over whole tables, and the SQL where it can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import (
    alignment, cascade, chat, crossparse, dealing, pieces, pigeonring, quality, redirects, spelling, termprint, tiling, wavelet,
)

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file, a few MB; executors get its bytes from the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encode_and_read(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_dealing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    dealt = dealing.shuffle_into_shards(docs.select("doc_id", "text"), shards=40, seed=0, settled=True)
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pigeonring.near_duplicates(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", pigeonring.hex_print(F.col("simhash")).alias("fingerprint"), "component_id")


def op5_crossparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossparse.predicted(read(spark, sf_dir, "documents"))


def op6_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles", F.size("item_ids").alias("n_items"), F.lit(True).alias("contaminated"))


def op7_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = redirects.judge_pages(read(spark, sf_dir, "pages"), redirects.rule_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_termprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termprint.compare_edits(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", termprint.hex_print(F.col("simhash")).alias("fingerprint"),
        termprint.hex_print(F.col("edited_simhash")).alias("edited_fingerprint"), "near_edited", "near_next",
        "n_within")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(
        read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"], lists=False)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(added)))


def op11_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = cascade.judge(docs, cascade.measure(docs).rules, keep=["doc_id"], whole=True)
    failed = [rule.fails(*map(F.col, rule.counts)) for rule in cascade.BASE]
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (failed[0] | failed[1]).alias("base_failed"), "kept")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"),
        keep=["doc_id"])[0]


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(read(spark, sf_dir, "documents"), spelled=spelling.typo)
    return spelling.variants(words).select("word", "n", "n_near", "form", "form_n", "root")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_wavelet, op2_dealing, op3_quality, op4_pigeonring, op5_crossparse, op6_tiling, op7_redirects,
        op8_termprint, op9_pieces, op10_chat, op11_cascade, op12_alignment, op13_spelling, pipeline)
}

#: What SQL can tell without the operators' own arithmetic; tests hold the rest against brute force, round
#: trips, the tokenizers' libraries and held-out labels.
ORACLES: dict[str, str] = {
    "op10_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length(role) + 15 + length(replace(replace(text, '\', '\b'), '<', '\l'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op11_cascade": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        spots AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
        windows AS (
            SELECT doc_id, i, w, lead(w) OVER next AS w2, lead(w, 2) OVER next AS w3 FROM spots
            WINDOW next AS (PARTITION BY doc_id ORDER BY i)),
        again AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS times FROM windows WHERE w3 IS NOT NULL)
            WHERE times > 1),
        repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
        l AS (
            SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
        c AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
                CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
            FROM d JOIN l USING (doc_id) LEFT JOIN repeats USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars BETWEEN 3 * n_words AND 10 * n_words
                AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines AS kept
        FROM c
    """,
    # the given pages have no redirects or canonical links; tests hold aliases against brute force
    "op7_redirects": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        p AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(verdict, rhost, rpath, rule) AS (VALUES ('allow', 'org', '/', 'org/'), ('block', 'example.org', '/es/', 'example.org/es/'),
            ('block', 'example.org', '/en/1', 'example.org/en/1'), ('allow', 'com', '/fr/', 'com/fr/'), ('block', 'com', '/de/', 'com/de/')),
        best AS (
            SELECT page_id, p.host, p.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
    """,
}
