"""SQL building blocks shared by several counterparts."""

from __future__ import annotations

from foliary.functions.news import NEWS_KEYS
from foliary.functions.text import LANGUAGES, MARK_LETTERS, STOP_WORDS

from workload.feed import FEED_SQL


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def text_of(path: str, json: str = "body") -> str:
    return f"json_extract_string({json}, '$.{path}')"


def language(text: str) -> str:
    """Language code of a text, by the scoring rule of the detector."""
    scripts = {
        "rus": r"[\x{400}-\x{52f}]",
        "ara": r"[\x{600}-\x{6ff}\x{750}-\x{77f}\x{fb50}-\x{fdff}\x{fe70}-\x{fefc}]",
    }
    known = in_list(sorted({w for words in STOP_WORDS.values() for w in words}))
    scores = []
    for lang in LANGUAGES:
        if lang in STOP_WORDS:
            score = f"len(list_filter(hits, lambda w: w IN {in_list(STOP_WORDS[lang])}))"
            for letter in MARK_LETTERS.get(lang, ""):
                score += f" + CAST(contains(low, '{letter}') AS INT)"
        else:
            own = f"(length(t) - length(regexp_replace(t, '{scripts[lang]}+', '', 'g')))"
            latin = r"(length(t) - length(regexp_replace(t, '\p{Latin}+', '', 'g')))"
            score = f"CASE WHEN {own} > {latin} THEN {own} + 1000 ELSE 0 END"
        scores.append(f"({score})")
    best = "greatest(" + ", ".join(f"s[{i + 1}]" for i in range(len(scores))) + ")"
    pick = " ".join(f"WHEN s[{i + 1}] = {best} THEN '{lang}'" for i, lang in enumerate(LANGUAGES))
    return f"""(SELECT CASE WHEN {best} = 0 THEN 'und' {pick} END FROM (
        SELECT [{', '.join(scores)}] AS s FROM (
          SELECT t, low, list_filter(list_distinct(regexp_split_to_array(low, '[^\\p{{L}}]+')), lambda w: w IN {known}) AS hits
          FROM (SELECT {text} AS t, lower({text}) AS low))))"""


def shingles(source: str, key: str = "doc_id", max_words: int | None = None, window: int = 10) -> str:
    """CTEs sh(key, g) of distinct shingles and sz(key, n) of ``source(key, text)``."""
    words = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"
    if max_words is not None:
        words = f"list_slice({words}, 1, {max_words})"
    return f"""
    wd AS (SELECT {key}, {words} AS w FROM {source}),
    sh AS (SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + {window - 1}), ' ') AS g
           FROM wd, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) t(i) WHERE len(w) > 0),
    sz AS (SELECT {key}, count(*) AS n FROM sh GROUP BY {key}),
    pr AS (SELECT a.{key} AS x, b.{key} AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.{key} <> b.{key} GROUP BY ALL),
    sim AS (SELECT x, y FROM pr JOIN sz p ON p.{key} = x JOIN sz q ON q.{key} = y WHERE 100 * c >= 90 * (p.n + q.n - c))"""


IS_NEWS = f"""(list_contains(json_keys(body), 'an')
    AND len(list_filter(json_keys(body), lambda k: k NOT IN {in_list(NEWS_KEYS)})) = 0
    AND len(list_filter(json_keys(body), lambda k: json_type(json_extract(body, '$."' || k || '"')) <> 'VARCHAR')) = 0)"""
IS_CANONICAL = "coalesce(json_type(body, '$.document_id') = 'VARCHAR', false)"
IS_PULSE = """(coalesce(json_type(body, '$.norm.body') = 'VARCHAR', false)
    AND coalesce(json_type(body, '$.norm.author') = 'VARCHAR', true))"""


def day(millis: str) -> str:
    return f"CAST(make_timestamp(CAST(CASE WHEN regexp_matches({millis}, '^[+-]?[0-9]+$') THEN {millis} END AS BIGINT) * 1000) AS DATE)"


CREATED = f"""CASE WHEN {text_of('publication_date')} IS NOT NULL AND {text_of('publication_datetime')} <> ''
    THEN {day(text_of('publication_datetime'))} END"""
MODIFIED = day(text_of("modification_datetime"))
BAD_DATES = f"""({text_of('publication_date')} IS NOT NULL AND ({text_of('publication_datetime')} IS NULL
    OR ({text_of('publication_datetime')} <> '' AND {day(text_of('publication_datetime'))} IS NULL))
    OR coalesce({text_of('modification_datetime')} <> '', false) AND {MODIFIED} IS NULL)"""
AUTHOR = r"CASE WHEN length({0}) > 0 THEN trim(regexp_replace({0}, '^.*\b(b|B)(y|Y)\b(.|:)?\s{{1,}}', '')) ELSE '' END"
ARTICLE = f"""CASE WHEN {text_of('snippet')} IS NULL THEN {text_of('body')}
    WHEN {text_of('body')} IS NULL THEN {text_of('snippet')}
    ELSE {text_of('snippet')} || chr(10) || {text_of('body')} END"""

# Every readable event with its format, error and converted text.
ROUTED_SQL = FEED_SQL + f""",
formats AS (SELECT *, CASE WHEN {IS_NEWS} THEN 'news' WHEN {IS_CANONICAL} THEN 'canonical'
    WHEN {IS_PULSE} THEN 'pulse' END AS format FROM events_in),
routed AS (SELECT *, CASE WHEN format IS NULL THEN 'unrecognised format'
    WHEN format = 'news' AND {BAD_DATES} THEN 'conversion failed'
    WHEN format = 'pulse' AND {text_of('norm_attribs')} IS NULL THEN 'conversion failed' END AS failure,
  CASE format WHEN 'news' THEN {ARTICLE} WHEN 'pulse' THEN {text_of('norm.body')}
    WHEN 'canonical' THEN {text_of('extracted_text')} END AS text,
  CASE format WHEN 'canonical' THEN {text_of('document_id')} ELSE doc_id END AS target_id
  FROM formats),
gated AS (SELECT *, CASE WHEN failure IS NULL THEN {language('text')} END AS lang3 FROM routed),
accepted AS (SELECT * EXCLUDE (failure), coalesce(failure,
    CASE WHEN lang3 <> 'eng' THEN lang3 || ' is not supported for: ' || target_id END) AS error FROM gated)"""

STORED_SQL = """
stored AS (SELECT 'D' || doc_id AS id, -1000000000 + doc_id AS pos, text, source, lang, quality, heading FROM raw WHERE toxic = 1)"""

# Decisions of the whole feed against the stored documents; one text per id, so one pass decides.
DECIDED_SQL = ROUTED_SQL + "," + STORED_SQL + """,
nodes AS (SELECT target_id AS id, min(seq) AS pos, any_value(text) AS text FROM accepted
  WHERE error IS NULL AND target_id NOT IN (SELECT id FROM stored) GROUP BY target_id),
pool AS (SELECT id, pos, text FROM nodes UNION ALL SELECT id, pos, text FROM stored),""" + shingles("pool", "id") + f""",
hits AS (SELECT n.id, min_by(p.id, p.pos) AS hit FROM nodes n JOIN sim ON sim.x = n.id JOIN pool p ON p.id = sim.y AND p.pos < n.pos GROUP BY n.id),
fresh AS (SELECT id, pos FROM nodes WHERE id NOT IN (SELECT id FROM hits) AND id IN (SELECT id FROM sz)),
placed AS (SELECT a.*, h.hit, f.pos AS new_at, CASE WHEN a.error IS NOT NULL THEN 'ERROR'
    WHEN s.id IS NOT NULL OR a.seq > f.pos THEN 'EXISTING' WHEN a.seq = f.pos THEN 'NEW'
    WHEN a.target_id NOT IN (SELECT id FROM sz) THEN 'ERROR' ELSE 'DUPLICATE' END AS place
  FROM accepted a LEFT JOIN stored s ON s.id = a.target_id LEFT JOIN fresh f ON f.id = a.target_id
  LEFT JOIN hits h ON h.id = a.target_id),
aimed AS (SELECT p.*, CASE WHEN place = 'EXISTING' THEN target_id
    WHEN place = 'DUPLICATE' AND (hit IN (SELECT id FROM stored) OR EXISTS (SELECT 1 FROM fresh f WHERE f.id = hit AND f.pos < p.seq))
    THEN hit END AS goes_to FROM placed p),
base AS (
  SELECT id, ['stored', 'quality' || quality] AS labels, [source, 'archive'] AS tenants, 'file:///' || source AS source_uri, 'archive' AS genre FROM stored
  UNION ALL
  SELECT target_id, list_distinct(CASE format WHEN 'canonical' THEN [json_extract_string(body, '$.labels[0]')] ELSE [] END || labels), tenants,
    coalesce(source_uri, CASE format WHEN 'news' THEN json_extract_string(body, '$.an')
      WHEN 'pulse' THEN coalesce(json_extract_string(body, '$.norm.url'), '') ELSE json_extract_string(body, '$.source_uri') END), genre
  FROM placed WHERE place = 'NEW'),
msg AS (SELECT goes_to AS id, seq, labels, tenants, source_uri, genre, run_annotators FROM aimed WHERE goes_to IS NOT NULL),
first_label AS (SELECT id, l, min(seq) AS seq FROM (SELECT id, seq, unnest(labels) AS l FROM msg) GROUP BY id, l),
first_tenant AS (SELECT id, t, min(seq) AS seq FROM (SELECT id, seq, unnest(tenants) AS t FROM msg) GROUP BY id, t),
label_change AS (SELECT DISTINCT f.id, f.seq FROM first_label f JOIN base b USING (id) WHERE NOT list_contains(b.labels, l)),
tenant_change AS (SELECT DISTINCT f.id, f.seq FROM first_tenant f JOIN base b USING (id) WHERE NOT list_contains(b.tenants, t)),
prior AS (SELECT m.*, coalesce(last_value(m.source_uri IGNORE NULLS) OVER w, b.source_uri) AS old_uri, coalesce(lag(m.genre) OVER (PARTITION BY id ORDER BY seq), b.genre) AS old_genre
  FROM msg m JOIN base b USING (id) WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
changes AS (SELECT p.id, p.seq, CASE WHEN run_annotators OR genre IS DISTINCT FROM old_genre
    OR (source_uri IS NOT NULL AND source_uri IS DISTINCT FROM old_uri)
    OR EXISTS (SELECT 1 FROM label_change c WHERE c.id = p.id AND c.seq = p.seq)
    OR EXISTS (SELECT 1 FROM tenant_change c WHERE c.id = p.id AND c.seq = p.seq) THEN 'UPDATE' ELSE 'NOOP' END AS change FROM prior p),
decided AS (SELECT a.seq, a.doc_id, a.target_id, CASE WHEN place = 'EXISTING' THEN c.change ELSE place END AS outcome,
    CASE WHEN place = 'DUPLICATE' THEN hit END AS duplicate_of, CASE WHEN place = 'DUPLICATE' THEN c.change END AS target_change,
    CASE WHEN error IS NOT NULL THEN 'ingestion' WHEN place = 'ERROR' THEN 'deduplication'
      WHEN place = 'DUPLICATE' AND goes_to IS NULL THEN 'ingestion' END AS operation,
    CASE WHEN error IS NOT NULL THEN error WHEN place = 'ERROR' THEN 'deduplication failed - no text'
      WHEN place = 'DUPLICATE' AND goes_to IS NULL THEN 'original not stored' END AS message,
    place = 'NEW' OR (place = 'EXISTING' AND run_annotators) AS run_annotators, a.body, a.format, a.labels, a.tenants, a.source_uri, a.genre, a.text
  FROM aimed a LEFT JOIN changes c ON c.seq = a.seq)"""
