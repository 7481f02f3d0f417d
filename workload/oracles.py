"""SQL counterparts of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from foliary.operators.ligatures import DEFAULT_WORDS

from workload import sql as S
from workload.feed import KEY_SQL, PROCESSED_MS, RAW_SQL, RESEND

FEED = "WITH " + S.FEED_SQL
RAW = "WITH " + RAW_SQL
ROUTED = "WITH " + S.ROUTED_SQL
STORED = "WITH " + RAW_SQL + "," + S.STORED_SQL
#: The same for all documents.
ARCHIVED = STORED.replace(" WHERE toxic = 1)", ")")
DECIDED = "WITH " + S.DECIDED_SQL
t = S.text_of


def joined(names: str) -> str:
    return f"array_to_string(list_sort({names}), '|')"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'true' ELSE 'false' END"


# --- envelopes ----------------------------------------------------------------------------------

# All envelopes as sent, metadata columns null where the metadata block is missing.
SENT = RAW + f""", sent AS (
  SELECT doc_id AS seq, {KEY_SQL} AS doc_id, shape, lang = 'es' AND quality IS NULL AS bare,
    [source, lang] AS tenants, CASE WHEN quality IS NOT NULL THEN ['quality' || quality, 'toxic' || toxic] END AS labels,
    genre, link AS source_uri, toxic = 1 AS again FROM raw
  UNION ALL
  SELECT doc_id + {RESEND}, {KEY_SQL}, shape, false, [source, 'review'], ['quality' || quality], 'revised', NULL, toxic = 1
  FROM raw WHERE quality IS NOT NULL),
visible AS (SELECT seq, doc_id, shape, shape <> 'broken' AS parsed, shape <> 'broken' AND NOT bare AS has, tenants, labels, genre, source_uri, again FROM sent)"""
_META = """CASE WHEN has THEN array_to_string(list_sort(tenants), '|') END AS tenants,
  CASE WHEN has THEN array_to_string(list_sort(labels), '|') END AS labels, CASE WHEN has THEN genre END AS genre,
  CASE WHEN has THEN source_uri END AS source_uri,
  CASE WHEN has AND again THEN 'true' WHEN has AND NOT again THEN 'false' END AS reannotate"""

# --- converted documents --------------------------------------------------------------------------

_KIND = t("norm_attribs.type")
_LOOKUP = """codes_all AS (SELECT 'subject' AS kind, lower(source) AS code, 'Source ' || source AS label FROM documents
  UNION SELECT 'region', lower(n_name), upper(n_name[1]) || lower(n_name[2:]) FROM nation
  UNION SELECT 'industry', lower(p_brand), p_brand || ' goods' FROM part),
codes AS (SELECT kind, code, max(label) AS label FROM codes_all GROUP BY kind, code)"""
_FACET_NAMES = "CASE kind WHEN 'subject' THEN 'factiva-subjects' WHEN 'region' THEN 'factiva-regions' ELSE 'factiva-industries' END"

FLAT_COLUMNS = """seq, document_id, capture_source, content_type, extracted_text, source_uri, labels, creation_date,
  modification_date, author, doc_type, description, original_language, classification, title, publisher, url, pages,
  producer, stated_genre, annotations"""


def _news_row(labels="''", source=t("an"), genre="NULL") -> str:
    notes = "array_to_string(list_filter([" + ", ".join(
        f"CASE WHEN length({t(k + '_codes')}) > 0 THEN '{n}' END"
        for k, n in (("subject", "factiva-subjects"), ("region", "factiva-regions"), ("industry", "factiva-industries"))
    ) + "], lambda x: x IS NOT NULL), '|')"
    return f"""seq, doc_id AS document_id, 'AutoCollection' AS capture_source, 'application/json' AS content_type,
  text AS extracted_text, {source} AS source_uri, {labels} AS labels, CAST({S.CREATED} AS VARCHAR) AS creation_date,
  CAST({S.MODIFIED} AS VARCHAR) AS modification_date, {S.AUTHOR.format(t('byline'))} AS author,
  {t('document_type')} AS doc_type, {t('snippet')} AS description, {t('language_code')} AS original_language,
  'UNCLASSIFIED' AS classification, {t('title')} AS title, {t('publisher_name')} AS publisher, '' AS url,
  CAST(NULL AS VARCHAR) AS pages, 'Dow Jones' AS producer, {genre} AS stated_genre, {notes} AS annotations"""


def _pulse_row(labels="''", source=f"coalesce({t('norm.url')}, '')", genre="NULL") -> str:
    return f"""seq, doc_id AS document_id, 'pulse_' || {_KIND} AS capture_source, {_KIND} AS content_type,
  text AS extracted_text, {source} AS source_uri, {labels} AS labels, substr({t('norm.timestamp')}, 1, 10) AS creation_date,
  NULL AS modification_date, '' AS author, {_KIND} AS doc_type, '' AS description, 'en' AS original_language,
  'UNCLASSIFIED' AS classification, coalesce({t('meta.title[0].results[0]')}, '') AS title, {t('norm.author')} AS publisher,
  {t('norm.url')} AS url, CAST(NULL AS VARCHAR) AS pages, 'Pulse' AS producer, {genre} AS stated_genre, '' AS annotations"""


def _canonical_row(labels=t("labels[0]"), source=t("source_uri"), genre=t("extracted_metadata.StatedGenre")) -> str:
    m = "extracted_metadata."
    return f"""seq, {t('document_id')} AS document_id, {t('capture_source')} AS capture_source, {t('content_type')} AS content_type,
  text AS extracted_text, {source} AS source_uri, {labels} AS labels, {t(m + 'CreationDate')} AS creation_date,
  NULL AS modification_date, NULL AS author, NULL AS doc_type, NULL AS description, {t(m + 'OriginalLanguage')} AS original_language,
  NULL AS classification, {t(m + 'Title')} AS title, NULL AS publisher, NULL AS url, {t(m + 'Pages')} AS pages,
  NULL AS producer, {genre} AS stated_genre, 't1|f1' AS annotations"""


def _flat(kind: str, row: str) -> str:
    return f"SELECT {FLAT_COLUMNS} FROM (SELECT {row} FROM routed WHERE format = '{kind}' AND failure IS NULL)"


def _new_flat() -> str:
    """New documents with their overrides; the texts hold nothing the clean-up changes but spaces before commas."""
    own = {
        "news": ("[]", t("an")), "pulse": ("[]", f"coalesce({t('norm.url')}, '')"),
        "canonical": (f"[{t('labels[0]')}]", t("source_uri")),
    }
    parts = []
    for kind, row in (("news", _news_row), ("pulse", _pulse_row), ("canonical", _canonical_row)):
        had, uri = own[kind]
        built = row(joined(f"list_distinct({had} || labels)"), f"coalesce(source_uri, {uri})", "genre")
        parts.append(f"SELECT {FLAT_COLUMNS.replace('extracted_text', CLEANED)} FROM (SELECT {built} FROM decided WHERE outcome = 'NEW' AND format = '{kind}')")
    return " UNION ALL ".join(parts)


CLEANED = r"regexp_replace(extracted_text, '\s+,', ',', 'g') AS extracted_text"

# --- text -----------------------------------------------------------------------------------------

_DAMAGE = " dash － , soft­hyphen “and” a confl ict of staff ices, di ff erent"
DAMAGED = f"""WITH damaged AS (SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN d.text || '{_DAMAGE}' ELSE d.text END AS text
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _char_class(*codes: int) -> str:
    return "[" + "".join(f"\\x{{{c:x}}}" for c in codes) + "]"


def normalized(text: str) -> str:
    """The same clean-up; joiners are not looked at, the tables have none."""
    steps = [
        (_char_class(0xAD, 0x200B, 0x200E, 0x200F, 0x202A, 0x202B, 0x202C, 0x202D, 0x202E, 0x2060, 0xFEFF), ""),
        (_char_class(0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2015, 0x2212, 0xFE58, 0xFE63, 0xFF0D), "-"),
        (_char_class(0x2018, 0x2019, 0x201A, 0x201B), "''"),
        (_char_class(0x201C, 0x201D, 0x201E, 0x201F), '"'),
        (r"\s+,", ","),
    ]
    for pattern, new in steps:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return text


_LEFT = r"regexp_replace({0}, '^[^\p{{L}}]+', '')"
_RIGHT = r"regexp_replace({0}, '(?s)[^\p{{L}}].*$', '')"
LIGATURES = DAMAGED + f""", toks AS (SELECT doc_id, text, string_split(text, ' ') AS k FROM damaged),
seams AS (SELECT doc_id, i, lower({_LEFT.format('k[i]')}) AS l, lower({_RIGHT.format('k[i + 1]')}) AS r
  FROM toks, unnest(range(1, len(k))) u(i)),
spots AS (SELECT DISTINCT l, r FROM seams WHERE regexp_full_match(l, '\\p{{L}}*(ff|fi|fl)') AND regexp_full_match(r, '\\p{{L}}+')),
heard AS (SELECT doc_id, unnest(list_distinct(regexp_split_to_array(regexp_replace(lower(text), '\\p{{L}}*(ff|fi|fl) (\\p{{L}})', ' \\2', 'g'), '[^\\p{{L}}]+'))) AS w FROM damaged),
lex AS (SELECT w FROM heard GROUP BY w HAVING count(*) >= 2 UNION SELECT unnest([{', '.join("'" + w + "'" for w in DEFAULT_WORDS)}])),
ok AS (SELECT l, r FROM spots WHERE l || r IN (SELECT w FROM lex) AND l NOT IN (SELECT w FROM lex)),
glue AS (SELECT s.doc_id, s.i FROM seams s JOIN ok USING (l, r))
SELECT doc_id, string_agg(tok || CASE WHEN i = n OR glued THEN '' ELSE ' ' END, '' ORDER BY i) AS text FROM (
  SELECT t.doc_id, i, len(k) AS n, k[i] AS tok, g.i IS NOT NULL AS glued
  FROM (SELECT doc_id, k, unnest(range(1, len(k) + 1)) AS i FROM toks) t LEFT JOIN glue g USING (doc_id, i)) GROUP BY doc_id"""

# A word counts from the second document on that holds it.
_LEX = LIGATURES[LIGATURES.index("lex AS ("):LIGATURES.index("glue AS (")]
LIGATURES_IN_ORDER = LIGATURES.replace(_LEX, f"""lex AS (
  SELECT w, min(since) AS since FROM (
    SELECT w, doc_id AS since FROM heard QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id) = 2
    UNION ALL SELECT unnest([{', '.join("'" + w + "'" for w in DEFAULT_WORDS)}]), -1) GROUP BY w),
""").replace("JOIN ok USING (l, r))", """JOIN spots USING (l, r) JOIN lex m ON m.w = l || r AND m.since < s.doc_id
  LEFT JOIN lex o ON o.w = l AND o.since < s.doc_id WHERE o.w IS NULL)""")

LEARNED = r"""WITH words AS (
  SELECT doc_id, lang, unnest(list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}]+'))) AS w FROM documents),
grams AS (
  SELECT doc_id, lang, substr(' ' || w || ' ', i, 3) AS g FROM (
    SELECT doc_id, lang, w, unnest(range(1, length(w) + 1)) AS i FROM words WHERE w <> '')),
counted AS (SELECT lang, g, count(*) AS n FROM grams WHERE lang IS NOT NULL AND doc_id % 4 <> 2 GROUP BY ALL),
chosen AS (SELECT DISTINCT g FROM (SELECT lang, g FROM counted QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, g) <= 1500)),
langs AS (SELECT DISTINCT lang FROM counted JOIN chosen USING (g)),
cells AS (SELECT g, lang, coalesce(n, 0) + 0.5 AS n FROM chosen CROSS JOIN langs LEFT JOIN counted USING (g, lang)),
weights AS (SELECT g, lang, CAST(floor(1000 * ln(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY lang)) + 0.5) AS BIGINT) AS weight FROM cells),
sums AS (SELECT doc_id, weights.lang AS l, sum(weight) AS s FROM grams JOIN weights USING (g) GROUP BY ALL),
best AS (SELECT doc_id, l FROM sums QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, l) = 1),
told AS (SELECT doc_id, doc_id % 4 = 2 AS held_out, coalesce(l, 'und') AS language FROM documents LEFT JOIN best USING (doc_id))"""

# --- merges on stored documents -------------------------------------------------------------------

ON_STORED = "WITH " + S.ROUTED_SQL + "," + S.STORED_SQL + """,
pairs AS (SELECT a.*, s.id, s.source, s.quality AS q, s.text AS old_text, s.heading AS old_title FROM accepted a JOIN stored s ON s.id = a.target_id WHERE error IS NULL)"""

MESSAGES = """WITH msg AS (SELECT 'U' || user_id AS target_id, event_id AS seq, event_type AS label,
    CASE WHEN event_type = 'view' THEN 'uri:' || json_extract_string(props, '$.k') END AS source_uri,
    'tenant' || json_extract_string(props, '$.k') AS tenant,
    CASE event_type WHEN 'purchase' THEN 'shop' WHEN 'error' THEN 'log' ELSE 'unspecified' END AS genre,
    event_type = 'signup' AND value > 15 AS run FROM events)"""

ONTOLOGIES = """ont AS (SELECT 'src' || user_id AS tenant, max_by(event_type || '-' || event_id, event_id) AS id FROM events GROUP BY user_id)"""
STORED_TENANTS = """st AS (SELECT DISTINCT id, unnest([source, 'archive']) AS tenant FROM stored)"""


def _similar(source: str, key: str = "doc_id", max_words: int | None = None) -> str:
    return "WITH " + S.shingles(source, key, max_words) + f" SELECT x AS {key}, min(y) AS first_duplicate FROM sim WHERE y < x GROUP BY x"


# --- annotators -----------------------------------------------------------------------------------

ANNOTATE = r"""WITH docs AS (SELECT 'D' || doc_id AS doc_id, text FROM documents WHERE length(text) > 0),
raw AS (
  SELECT doc_id, 'first-word' AS label, 0 AS position, regexp_extract(text, '^\S+') AS content, length(regexp_extract(text, '^\S+')) > 0 AS given, true AS kept FROM docs
  UNION ALL
  SELECT doc_id, 'shouts', 1, f, true, length(f) > 0 FROM (SELECT doc_id, array_to_string(
      list_transform(list_sort(list_transform(list_distinct(x), lambda w: {'i': list_position(x, w), 'w': w})), lambda e: e.w), '|') AS f
    FROM (SELECT doc_id, regexp_extract_all(text, '([A-Z]+)!!', 1) AS x FROM docs))
  UNION ALL
  SELECT doc_id, 'shape', 2, CAST(len(string_split(text, chr(10))) AS VARCHAR), len(string_split(text, chr(10))) > 1, true FROM docs),
results AS (SELECT doc_id, label, position, CASE WHEN given AND kept THEN 'result' ELSE 'none' END AS status,
    CASE WHEN given AND kept THEN content END AS content FROM raw)"""
_DEFS = """SELECT p_brand AS label, max(p_size) AS size, min(p_partkey) AS port FROM part GROUP BY p_brand"""
_HOST = "CASE WHEN size < 50 THEN 'host-' || size ELSE 'shared' END AS host"

_STATUS = f"""status AS (
  SELECT target_id AS doc_id, s AS stage, 'SUCCESS' AS status, '' AS message FROM decided, unnest(['ingestion', 'core-processing']) u(s) WHERE outcome IN ('NEW', 'UPDATE')
  UNION ALL SELECT target_id, 'ingestion', 'FAILURE', target_id || ' duplicates: ' || duplicate_of FROM decided WHERE outcome = 'DUPLICATE'
  UNION ALL SELECT duplicate_of, s, 'SUCCESS', '' FROM decided, unnest(['ingestion', 'core-processing']) u(s) WHERE outcome = 'DUPLICATE' AND target_change = 'UPDATE'
  UNION ALL SELECT target_id, 'Document Processing Error', 'FAILURE', operation || ': ' || message FROM decided WHERE message IS NOT NULL)"""
_ERRORS = """errs AS (SELECT seq, target_id AS doc_id, operation,
    message AS error_msg, operation || ': ' || message AS stacktrace FROM decided WHERE message IS NOT NULL)"""
_OUTCOME = f"""seq, doc_id, target_id, outcome, duplicate_of, target_change, operation, message, {flag('run_annotators')} AS run_annotators"""

_FOLDED = """folded AS (SELECT id, max(run_annotators) AS run, max_by(genre, seq) AS genre,
    max_by(source_uri, seq) FILTER (source_uri IS NOT NULL) AS uri, list_distinct(flatten(list(labels))) AS labels FROM msg GROUP BY id)"""
_AFTER = f"""after AS (
  SELECT b.id, {joined("list_distinct(b.labels || coalesce(f.labels, []))")} AS labels, coalesce(f.uri, b.source_uri) AS source_uri,
    coalesce(f.genre, b.genre) AS genre, coalesce(f.run, false) AS run FROM base b LEFT JOIN folded f USING (id))"""
_MEMBERS = """members AS (SELECT id, unnest([source, 'archive']) AS tenant FROM stored
  UNION SELECT target_id, unnest(tenants) FROM placed WHERE place = 'NEW' UNION SELECT id, unnest(tenants) FROM msg)"""

ORACLES = {
    "dim_codes": f"WITH {_LOOKUP} SELECT kind, code, label FROM codes",
    "envelope_parse": f"{SENT} SELECT seq, doc_id, {flag('parsed')} AS parsed, {_META} FROM visible",
    "envelope_roundtrip": f"{SENT} SELECT seq, 'true' AS parsed, {_META} FROM visible WHERE parsed",
    "overrides": f"""{FEED} SELECT seq, {joined('labels')} AS labels, {joined('tenants')} AS tenants, source_uri, genre,
        {flag('run_annotators')} AS run_annotators FROM events_in""",
    "validate_news": f"{FEED} SELECT seq, {flag(S.IS_NEWS)} AS valid FROM events_in",
    "validate_pulse": f"{FEED} SELECT seq, {flag(S.IS_PULSE)} AS valid FROM events_in",
    "route_format": f"{ROUTED} SELECT seq, doc_id, format, failure AS error, target_id FROM routed",
    "news_to_cdr": f"{ROUTED} {_flat('news', _news_row())}",
    "pulse_to_cdr": f"{ROUTED} {_flat('pulse', _pulse_row())}",
    "canonical_to_cdr": f"{ROUTED} {_flat('canonical', _canonical_row())}",
    "cdr_json": f"{ROUTED} {_flat('news', _news_row())} UNION ALL {_flat('pulse', _pulse_row())} UNION ALL {_flat('canonical', _canonical_row())}",
    "author_clean": f"{RAW} SELECT doc_id, {S.AUTHOR.format('byline')} AS author FROM raw",
    "epoch_dates": f"""{RAW}, m AS (SELECT *, CASE WHEN shape = 'news_bad_date' THEN 'never' ELSE modified END AS changed FROM raw)
        SELECT doc_id, CASE WHEN published <> '' THEN CAST({S.day('published')} AS VARCHAR) END AS creation,
        CAST({S.day('changed')} AS VARCHAR) AS modification, {flag("changed = 'never'")} AS bad FROM m""",
    "text_concat": f"""{RAW} SELECT doc_id, CASE WHEN toxic = 1 THEN snippet WHEN snippet IS NULL THEN text
        ELSE snippet || chr(10) || text END AS text FROM raw""",
    "code_facets": f"""{RAW}, {_LOOKUP}, lists AS (
        SELECT doc_id, 'subject' AS kind, subjects AS list FROM raw UNION ALL SELECT doc_id, 'region', regions FROM raw
        UNION ALL SELECT doc_id, 'industry', industries FROM raw),
        each AS (SELECT doc_id, kind, i, string_split(list, ',')[i] AS code FROM lists, unnest(range(1, len(string_split(list, ',')) + 1)) u(i) WHERE length(list) > 0)
        SELECT doc_id, {_FACET_NAMES} AS annotation, 'static' AS class, coalesce(string_agg(label, '|' ORDER BY i), '') AS facets
        FROM each LEFT JOIN codes USING (kind, code) GROUP BY doc_id, kind""",
    "code_join": f"""{RAW}, {_LOOKUP}, lists AS (
        SELECT doc_id, 'subject' AS kind, subjects AS list FROM raw UNION ALL SELECT doc_id, 'region', regions FROM raw
        UNION ALL SELECT doc_id, 'industry', industries FROM raw),
        kept AS (SELECT doc_id, kind, list_filter(string_split(list, ','), lambda c: c <> '') AS c FROM lists)
        SELECT e.doc_id, e.kind, e.pos, e.code, codes.label FROM (
          SELECT doc_id, kind, i - 1 AS pos, c[i] AS code FROM kept, unnest(range(1, len(c) + 1)) u(i)) e
        LEFT JOIN codes ON codes.kind = e.kind AND codes.code = e.code""",
    "text_normalize": f"{DAMAGED} SELECT doc_id, {normalized('text')} AS text FROM damaged",
    "ligature_repair": LIGATURES,
    "ligature_repair_in_order": LIGATURES_IN_ORDER,
    "language_id": f"SELECT doc_id, {S.language('text')} AS language FROM documents",
    "language_learned": LEARNED + " SELECT * FROM told",
    "language_agreement": LEARNED + """ SELECT lang, held_out, count(*) AS n, CAST(sum(CAST(language = lang AS INT)) AS BIGINT) AS agreeing,
        100 * sum(CAST(language = lang AS INT)) >= 99 * count(*) AS good FROM told JOIN documents USING (doc_id) WHERE lang IS NOT NULL GROUP BY ALL""",
    "language_gate": f"{ROUTED} SELECT seq, target_id, lang3 AS lang, error FROM accepted",
    "preprocess_chain": f"{ARCHIVED} SELECT id AS doc_id, lower(text) AS text, {joined('''['stored', 'quality' || coalesce(CAST(quality AS VARCHAR), '?'), 'seen']''')} AS labels FROM stored",
    "corpus_lookup": f"""{STORED} SELECT 'D' || d.doc_id AS doc_id, s.text AS text, CASE WHEN s.id IS NOT NULL THEN 'archive' END AS genre
        FROM documents d LEFT JOIN stored s ON s.id = 'D' || d.doc_id""",
    "corpus_exists": f"""{STORED} SELECT 'D' || doc_id AS doc_id, {flag("'D' || doc_id IN (SELECT id FROM stored)")} AS stored FROM documents""",
    "tenants_of_doc": f"{STORED} SELECT id AS doc_id, {joined('''[source, 'archive']''')} AS tenants FROM stored",
    "find_existing": f"""{STORED} SELECT 'D' || d.doc_id AS doc_id, 'file:///' || s.source AS source_uri,
        CASE WHEN s.id IS NULL THEN '' ELSE {joined("[s.source, 'archive']")} END AS tenants
        FROM documents d LEFT JOIN stored s ON s.id = 'D' || d.doc_id""",
    "merge_overrides": f"""{ON_STORED} SELECT seq, {joined("list_distinct(['stored', 'quality' || q] || labels)")} AS labels,
        coalesce(source_uri, 'file:///' || source) AS source_uri, genre FROM pairs""",
    "tenant_delta": f"""{ON_STORED} SELECT seq, CASE WHEN len(list_filter(tenants, lambda x: x <> source AND x <> 'archive')) > 0
        THEN {joined("list_distinct([source, 'archive'] || tenants)")} ELSE '' END AS tenants FROM pairs""",
    "needs_reannotate": f"""{ON_STORED} SELECT seq, {flag(f'''old_text IS DISTINCT FROM text OR old_title IS DISTINCT FROM
        CASE format WHEN 'news' THEN {t('title')} WHEN 'pulse' THEN coalesce({t('meta.title[0].results[0]')}, '') ELSE {t('extracted_metadata.Title')} END
        OR CASE format WHEN 'news' THEN {t('snippet')} WHEN 'pulse' THEN '' END IS NOT NULL''')} AS differs FROM pairs""",
    "strip_derived": f"{ARCHIVED} SELECT id AS doc_id, 'note-static' AS kept FROM stored",
    "fold_overrides": f"""{MESSAGES} SELECT target_id, {joined('list_distinct(list(label))')} AS labels, {joined('list_distinct(list(tenant))')} AS tenants,
        max_by(source_uri, seq) FILTER (source_uri IS NOT NULL) AS source_uri, max_by(genre, seq) AS genre,
        {flag('bool_or(run)')} AS run_annotators, max(seq) AS last_seq FROM msg GROUP BY target_id""",
    "change_log": f"""{MESSAGES}, f AS (SELECT *, label <> 'view' AND row_number() OVER (PARTITION BY target_id, label ORDER BY seq) = 1 AS nl,
        row_number() OVER (PARTITION BY target_id, tenant ORDER BY seq) = 1 AS nt,
        source_uri IS NOT NULL AND source_uri IS DISTINCT FROM last_value(source_uri IGNORE NULLS) OVER (PARTITION BY target_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nu,
        genre IS DISTINCT FROM coalesce(lag(genre) OVER (PARTITION BY target_id ORDER BY seq), 'unspecified') AS ng FROM msg)
        SELECT target_id, seq, {flag('nl')} AS new_labels, {flag('nt')} AS new_tenants, {flag('nu')} AS new_source_uri, {flag('ng')} AS new_genre,
        CASE WHEN nl OR nt OR nu OR ng OR run THEN 'UPDATE' ELSE 'NOOP' END AS change FROM f""",
    "near_duplicates": "SELECT *, '1.00' AS score FROM (" + _similar("documents") + ")",
    "near_duplicates_whole_text": _similar("documents", max_words=None),
    "near_duplicate_turns": _similar("(SELECT conv_id * 10000 + turn AS doc_id, text FROM conversations)"),
    "copies_of": "WITH " + S.shingles("documents", "doc_id", None) + """ SELECT x AS doc_id, y AS duplicate_id FROM sim
        WHERE y < x AND x IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "duplicate_lists": "WITH " + S.shingles("documents", "doc_id", None) + """ SELECT x AS doc_id, count(*) AS n,
        string_agg(y, '|' ORDER BY y) AS duplicates, x || ' duplicates: ' || string_agg('D' || y, '' ORDER BY y) AS message
        FROM sim WHERE y < x AND x % 20 = 0 GROUP BY x""",
    "ingest_outcome": f"{DECIDED} SELECT {_OUTCOME} FROM decided",
    "route_duplicates": f"""{DECIDED} SELECT m.id AS target_id, m.seq, {joined('labels')} AS labels, genre, c.change
        FROM msg m JOIN changes c ON c.seq = m.seq""",
    "core_new": f"{DECIDED} {_new_flat()}",
    "core_update": f"""{DECIDED}, {_FOLDED}, {_AFTER} SELECT id AS doc_id, labels, source_uri, genre,
        CASE WHEN run THEN 'note-static' ELSE 'note-derived|note-static' END AS annotations FROM after WHERE id IN (SELECT id FROM stored)""",
    "corpus_upsert": f"""{DECIDED}, {_FOLDED}, {_AFTER} SELECT a.id AS document_id, a.labels, a.source_uri, a.genre,
        CASE WHEN s.id IS NOT NULL THEN s.text ELSE regexp_replace(n.text, '\\s+,', ',', 'g') END AS extracted_text
        FROM after a LEFT JOIN stored s ON s.id = a.id LEFT JOIN placed n ON n.target_id = a.id AND n.place = 'NEW'""",
    "tenant_add": f"{DECIDED}, {_MEMBERS} SELECT tenant, id AS doc_id FROM members",
    "ontology_mapping": f"""{STORED}, {ONTOLOGIES}, {STORED_TENANTS} SELECT 'D' || d.doc_id AS doc_id,
        coalesce((SELECT string_agg(tenant || '=' || ont.id, '|' ORDER BY tenant || '=' || ont.id) FROM st JOIN ont USING (tenant) WHERE st.id = 'D' || d.doc_id), '') AS ontologies FROM documents d""",
    "notify_update": f"""{ARCHIVED}, {ONTOLOGIES} SELECT s.id AS key, s.id AS document_id, text, 'archive' AS genre, lang AS first_content,
        'note-static' AS second_label, ont.id AS ontology FROM stored s LEFT JOIN ont ON ont.tenant = s.source""",
    "notify_annotation": ANNOTATE.replace("raw AS (", "notes AS (").replace("FROM raw)", "FROM notes)") + ", " + RAW_SQL + "," + S.STORED_SQL
        + ", " + ONTOLOGIES + """ SELECT r.doc_id AS key, r.label, ont.id AS ontology FROM results r
        LEFT JOIN stored s ON s.id = r.doc_id LEFT JOIN ont ON ont.tenant = s.source WHERE r.status = 'result'""",
    "notify_duplicate": f"""{DECIDED} SELECT target_id AS key, target_id AS doc_id, duplicate_of AS duplicate, count(*) AS n
        FROM decided WHERE outcome = 'DUPLICATE' GROUP BY ALL""",
    "dead_letters": f"""{DECIDED}, {_ERRORS} SELECT doc_id, operation, error_msg, stacktrace, CAST({PROCESSED_MS} AS BIGINT) AS timestamp,
        count(*) AS n FROM errs GROUP BY ALL""",
    "error_rows": f"{DECIDED}, {_ERRORS} SELECT * FROM errs",
    "pipeline_status": f"""{DECIDED}, {_STATUS} SELECT doc_id, stage, 'CORE' AS processor_type, status, 'corpus' AS scope,
        CAST({PROCESSED_MS} AS BIGINT) AS start_ms, CAST({PROCESSED_MS} AS BIGINT) AS end_ms, message, count(*) AS n FROM status GROUP BY ALL""",
    "dup_status": f"""{DECIDED}, {_STATUS} SELECT doc_id, message, count(*) AS n FROM status
        WHERE stage = 'ingestion' AND status = 'FAILURE' GROUP BY ALL""",
    "thin_view": f"""{ARCHIVED} SELECT id AS doc_id, CAST(i AS BIGINT) AS pos, ['note-derived', 'note-static'][i + 1] AS label, lang AS content
        FROM stored, range(2) r(i)""",
    "dup_json": "SELECT doc_id, 'D' || first_duplicate AS duplicate, '1.00' AS score FROM (" + _similar("documents") + ")",
    "annotator_defs": f"""SELECT label, {_HOST}, port, {flag('size < 40')} AS post_process, 'annotate' AS path,
        CAST(6 AS BIGINT) AS retry_count, CAST(1000 AS BIGINT) AS retry_pause_ms FROM ({_DEFS})""",
    "annotators_enabled": f"SELECT label, {_HOST} FROM ({_DEFS}) WHERE label IN ('Brand#1', 'Brand#3', 'Brand#99')",
    "annotatable": "SELECT 'D' || doc_id AS doc_id FROM documents WHERE length(text) > 0",
    "annotation_queue": f"{DECIDED} SELECT seq, target_id FROM decided WHERE run_annotators",
    "annotator_fanout": """SELECT 'D' || doc_id AS doc_id, label, position FROM documents,
        (VALUES ('first-word', CAST(0 AS BIGINT)), ('shouts', 1), ('shape', 2)) v(label, position) WHERE length(text) > 0""",
    "annotate": f"{ANNOTATE} SELECT doc_id, label, status, content FROM results",
    "annotate_from_defs": f"""{ANNOTATE} SELECT doc_id, lower(r_name) AS label, status, content FROM results
        JOIN region ON r_regionkey = position WHERE lower(r_name) IN ('africa', 'america', 'asia')""",
    "annotate_retry": r"""SELECT 'D' || doc_id AS doc_id, CASE WHEN upper(text) = text THEN 'failed' WHEN NOT contains(text, chr(10)) THEN 'none' ELSE 'result' END AS status,
        CAST(CASE WHEN upper(text) = text THEN 3 ELSE 1 END AS BIGINT) AS attempts,
        CASE WHEN upper(text) <> text AND contains(text, chr(10)) THEN CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS VARCHAR) END AS words,
        CASE WHEN upper(text) = text THEN 'ValueError: all capitals' END AS error FROM documents WHERE length(text) > 0""",
    "tag_values": r"""SELECT doc_id, tag, value FROM (SELECT doc_id, 'E' AS tag, '😀' AS value FROM documents
        UNION ALL SELECT doc_id, 'W', regexp_extract(text, '^\S*') FROM documents)""",
    "annotation_relabel": f"""{ARCHIVED} SELECT id AS doc_id, was, 'x-text' AS label, lang AS text FROM stored, (VALUES ('note-derived'), ('note-static')) v(was)""",
    "annotation_nonempty": f"{ANNOTATE} SELECT doc_id, label, {flag('kept')} AS kept FROM raw WHERE given",
    "annotation_complete": "SELECT 'D' || doc_id AS doc_id, CAST(3 AS BIGINT) AS done, 'true' AS complete FROM documents WHERE length(text) > 0",
    "annotation_runs": """SELECT 'D' || doc_id AS doc_id, CAST(CASE WHEN bad OR lang = 'fr' THEN 1 ELSE 2 END AS BIGINT) AS done,
        CAST(CASE WHEN bad OR lang = 'fr' THEN 1 ELSE 0 END AS BIGINT) AS failed,
        CASE WHEN bad OR lang = 'fr' THEN 'false' ELSE 'true' END AS complete,
        CAST(CASE WHEN bad OR lang = 'fr' THEN 3 WHEN lang = 'es' THEN 2 ELSE 1 END AS BIGINT) AS rounds
        FROM (SELECT *, upper(text) = text AS bad FROM documents WHERE length(text) > 0)""",
    "search_parts": f"""{ARCHIVED} SELECT id AS document_id, CASE WHEN quality IS NOT NULL THEN 'seen' ELSE 'quality?|stored' END AS labels,
        CASE WHEN lang = 'en' THEN 'moved:' ELSE '' END || 'file:///' || source AS source_uri, text AS extracted_text,
        CAST(CASE WHEN lang = 'en' THEN 0 ELSE 2 END AS BIGINT) AS notes, {joined("[source, 'archive']")} AS tenants FROM stored""",
    "corpus_versions": f"""{ARCHIVED} SELECT id AS document_id, CAST(b AS BIGINT) AS before,
        CASE WHEN b = 3 AND lang = 'en' THEN 'third' WHEN b > 1 THEN 'second' ELSE 'file:///' || source END AS source_uri
        FROM stored, range(1, 4) r(b) WHERE quality IS NOT NULL""",
    "annotation_append": f"""{ANNOTATE} SELECT 'D' || d.doc_id AS doc_id, coalesce((SELECT string_agg(label, '|' ORDER BY position) FROM results r
        WHERE r.doc_id = 'D' || d.doc_id AND status = 'result'), '') AS annotations FROM documents d
        UNION ALL SELECT 'B' || doc_id, '' FROM labels""",
    "search_get": f"{STORED} SELECT id AS document_id, 'file:///' || source AS source_uri, {joined('''[source, 'archive']''')} AS tenants FROM stored WHERE quality = 1",
    "search_upsert": "WITH " + S.ROUTED_SQL + "," + S.STORED_SQL + f""",
        sent AS (SELECT target_id, text, CASE format WHEN 'news' THEN 'AutoCollection' WHEN 'pulse' THEN 'pulse_' || {_KIND} ELSE {t('capture_source')} END AS capture,
          CASE format WHEN 'news' THEN 'application/json' WHEN 'pulse' THEN {_KIND} ELSE {t('content_type')} END AS ctype,
          CASE format WHEN 'news' THEN {t('an')} WHEN 'pulse' THEN coalesce({t('norm.url')}, '') ELSE {t('source_uri')} END AS uri
          FROM accepted WHERE error IS NULL AND seq < {RESEND})
        SELECT coalesce(s.id, n.target_id) AS document_id, coalesce(n.capture, 'Archive') AS capture_source,
        coalesce(n.uri, 'file:///' || s.source) AS source_uri, n.ctype AS content_type, coalesce(n.text, s.text) AS extracted_text,
        CASE WHEN s.id IS NOT NULL THEN {joined("[s.source, 'archive']")} END AS tenants
        FROM stored s FULL JOIN sent n ON s.id = n.target_id""",
    "search_annotation": ANNOTATE.replace("raw AS (", "notes AS (").replace("FROM raw)", "FROM notes)") + ", " + RAW_SQL + "," + S.STORED_SQL + """
        SELECT id AS document_id, array_to_string(CASE WHEN lang = 'en' THEN ['note-derived', 'note-static'] ELSE [] END ||
        coalesce((SELECT list(label ORDER BY position) FROM results r WHERE r.doc_id = s.id AND status = 'result'), []), '|') AS annotations FROM stored s""",
    "search_tenants": f"""{DECIDED}, {_MEMBERS} SELECT id AS document_id, string_agg(tenant, '|' ORDER BY tenant) AS tenants
        FROM members WHERE id IN (SELECT id FROM stored) GROUP BY id""",
    "stream_ingest": DECIDED.replace("FROM raw WHERE toxic = 1)", "FROM raw WHERE false)") + """ SELECT seq, doc_id, target_id, outcome,
        duplicate_of, target_change, message FROM decided""",
    "stream_dedup": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(first_duplicate AS VARCHAR) AS first_duplicate FROM (" + _similar("documents") + ")",
}
