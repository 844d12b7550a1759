"""ANSI SQL twins of the registered queries, run by another engine."""

from __future__ import annotations

from doclake.checks.inputs import LEXICON
from doclake.constants import PROMPT_HEAD, PROMPT_QUESTION, PROMPT_TAIL

_SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_NOT_WORD = r"[^\p{L}\p{N}]+"


def _clean(text: str) -> str:
    steps = f"replace(coalesce({text}, ''), chr(160), ' ')"
    steps = f"regexp_replace({steps}, '{_SPACE}*32;{_SPACE}*', ' ', 'g')"
    steps = f"regexp_replace({steps}, '{_SPACE}+', ' ', 'g')"
    steps = rf"regexp_replace({steps}, '[^\p{{L}}\p{{N}}_ .,;:!?\-]', ' ', 'g')"
    return f"trim(regexp_replace({steps}, ' +', ' ', 'g'))"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- the layers as common table expressions ----------------------------------

_RAW = """
raw AS (
  SELECT concat(source, '/', doc_id, '.txt') AS file_name, 'text/plain' AS content_type,
    text AS text_content,
    CASE WHEN lang = 'de' THEN '' ELSE ' ' || source END AS author,
    CASE WHEN lang = 'en' THEN '  ' ELSE concat(source, ' ', lang, ' ') END AS title,
    '' AS created,
    CASE WHEN lang = 'es' THEN '' ELSE lang END AS language,
    CASE WHEN n_chars > 3000 THEN ' ' || (n_chars // 3000) WHEN n_chars < 500 THEN 'x' ELSE '' END
      AS num_pages,
    TIMESTAMP '2025-01-01 00:00:00' + to_seconds(doc_id) AS ingested_at
  FROM documents)"""

_CLEAN = f"""
clean AS (
  SELECT doc_id, lower(trim({_clean('text')})) AS text_clean FROM documents)"""

_SILVER = f"""{_RAW},
silver AS (
  SELECT * EXCLUDE (text_content), length(text_clean) AS text_length
  FROM (SELECT *, lower(trim({_clean('text_content')})) AS text_clean FROM raw)
  WHERE length(text_clean) > 50)"""


def _topics(source: str, key: str, out: str = "topics") -> str:
    """``key, topic`` for every row of ``source``."""
    rows = ", ".join(
        f"({_literal(label)}, {pos}, {_literal(term)})"
        for pos, (label, terms) in enumerate(LEXICON.items())
        for term in terms
    )
    first = _literal(next(iter(LEXICON)))
    return f"""
lexicon(label, pos, term) AS (VALUES {rows}),
{out}_hits AS (
  SELECT t.{key}, l.label, l.pos, count(*) AS n
  FROM (SELECT {key}, unnest(regexp_split_to_array(lower(text_clean), '{_NOT_WORD}')) AS term
        FROM {source}) t JOIN lexicon l USING (term)
  GROUP BY ALL),
{out}_best AS (
  SELECT {key}, label FROM {out}_hits
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, pos) = 1),
{out} AS (
  SELECT s.{key}, CASE WHEN coalesce(s.text_clean, '') = '' THEN 'desconhecido'
    ELSE coalesce(b.label, {first}) END AS topic
  FROM {source} s LEFT JOIN {out}_best b USING ({key}))"""


def _summaries(source: str, key: str, out: str = "summaries") -> str:
    """``key, summary`` for every row of ``source``."""
    return rf"""
{out}_split AS (
  SELECT {key}, string_split(regexp_replace(text_clean, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s
  FROM {source} WHERE length(text_clean) >= 100),
{out}_sentence AS (
  SELECT {key}, unnest(s) AS sentence, generate_subscripts(s, 1) AS place FROM {out}_split),
{out}_term AS (
  SELECT DISTINCT {key}, place, term FROM (
    SELECT {key}, place, unnest(regexp_split_to_array(lower(sentence), '{_NOT_WORD}')) AS term
    FROM {out}_sentence) WHERE term <> ''),
{out}_shared AS (SELECT {key}, term FROM {out}_term GROUP BY ALL HAVING count(*) > 1),
{out}_points AS (
  SELECT {key}, place, count(*) AS n FROM {out}_term JOIN {out}_shared USING ({key}, term) GROUP BY ALL),
{out}_best AS (
  SELECT s.* FROM {out}_sentence s LEFT JOIN {out}_points p USING ({key}, place)
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY coalesce(p.n, 0) DESC, place) <= 2),
{out}_joined AS (
  SELECT {key}, string_agg(sentence, ' ' ORDER BY place) AS summary FROM {out}_best GROUP BY ALL),
{out} AS (
  SELECT s.{key}, coalesce(j.summary, s.text_clean) AS summary
  FROM {source} s LEFT JOIN {out}_joined j USING ({key}))"""


_GOLD = f"""{_SILVER},
{_topics('silver', 'file_name')},
{_summaries('silver', 'file_name')},
gold AS (
  SELECT file_name, content_type, title, author, language, num_pages, text_length, topic, summary,
    ingested_at, TIMESTAMP '2025-03-01 12:00:00' AS processed_at,
    ingested_at + INTERVAL 2 HOUR AS enriched_at
  FROM silver JOIN topics USING (file_name) JOIN summaries USING (file_name))"""

_STAGING = f"""{_GOLD},
staging AS (
  SELECT file_name,
    CASE WHEN trim(title) = '' OR title IS NULL THEN file_name ELSE trim(title) END AS document_title,
    CASE WHEN trim(author) = '' OR author IS NULL THEN 'Desconhecido' ELSE trim(author) END
      AS document_author,
    CASE WHEN trim(language) <> '' THEN trim(language) END AS language,
    try_cast(trim(num_pages) AS INTEGER) AS num_pages,
    CAST(text_length AS INTEGER) AS text_length,
    trim(topic) AS topic, trim(summary) AS summary, content_type,
    ingested_at, processed_at, enriched_at
  FROM gold WHERE file_name IS NOT NULL)"""

_STATS = f"""{_STAGING},
stats AS (
  SELECT topic, count(*) AS total_documents, round(avg(text_length), 6) AS avg_text_length,
    round(avg(coalesce(num_pages, 1)), 6) AS avg_pages,
    min(ingested_at) AS first_ingested_at, max(ingested_at) AS last_ingested_at
  FROM staging GROUP BY topic)"""


def _times(*columns: str) -> str:
    return ", ".join(f"{_text(c)} AS {c}" for c in columns)


# --- hashed terms ------------------------------------------------------------

_TWO_32 = 4294967296


def _hash_buckets(source: str, out: str, dims: int) -> str:
    """``term, bucket`` by 32-bit Murmur3 with seed 42 over the UTF-8 bytes."""

    def word(at: str) -> str:
        return "('0x' || " + " || ".join(f"substr(h, {at} + {i}, 2)" for i in (7, 5, 3, 1)) + ")::UBIGINT"

    def last(*ends: int) -> str:
        return "('0x' || " + " || ".join(f"left(right(h, {e}), 2)" for e in ends) + ")::UBIGINT"

    def rotate(k: str, by: int) -> str:
        return f"(({k} * {2 ** by}) % {_TWO_32} + {k} // {2 ** (32 - by)})"

    step = rotate("xor(h, k)", 13)
    return f"""
{out}_1 AS (
  SELECT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n
  FROM (SELECT DISTINCT term FROM {source})),
{out}_2 AS (
  SELECT term, n, list_transform(range(0, n // 4), lambda i: {word('8 * i')}) AS ks,
    CASE n % 4 WHEN 0 THEN 0 WHEN 1 THEN {last(2)} WHEN 2 THEN {last(2, 4)}
      ELSE {last(2, 4, 6)} END AS t
  FROM {out}_1),
{out}_3 AS (
  SELECT term, n, list_transform(ks, lambda k: (k * 3432918353::UBIGINT) % {_TWO_32}) AS ks,
    (t * 3432918353::UBIGINT) % {_TWO_32} AS t FROM {out}_2),
{out}_4 AS (
  SELECT term, n,
    list_transform(ks, lambda k: ({rotate('k', 15)} * 461845907::UBIGINT) % {_TWO_32}) AS ks,
    ({rotate('t', 15)} * 461845907::UBIGINT) % {_TWO_32} AS t FROM {out}_3),
{out}_5 AS (
  SELECT term, xor(xor(list_reduce(ks, lambda h, k: ({step} * 5 + 3864292196) % {_TWO_32},
    42::UBIGINT), t), n::UBIGINT) AS h FROM {out}_4),
{out}_6 AS (
  SELECT term, (xor(h, h // 65536) * 2246822507::UBIGINT) % {_TWO_32} AS h FROM {out}_5),
{out}_7 AS (
  SELECT term, (xor(h, h // 8192) * 3266489909::UBIGINT) % {_TWO_32} AS h FROM {out}_6),
{out}_8 AS (SELECT term, xor(h, h // 65536)::BIGINT AS h FROM {out}_7),
{out} AS (
  SELECT term, ((h - CASE WHEN h >= 2147483648 THEN {_TWO_32} ELSE 0 END) % {dims} + {dims})
    % {dims} AS bucket FROM {out}_8)"""


def _tf(source: str, key: str, out: str, dims: int) -> str:
    """``key, bucket, tf``: term counts of ``text_clean`` per hash bucket."""
    return f"""
{out}_tokens AS (SELECT {key}, unnest(string_split(text_clean, ' ')) AS term FROM {source}),
{_hash_buckets(f'{out}_tokens', f'{out}_bucket', dims)},
{out} AS (
  SELECT {key}, bucket, count(*) AS tf FROM {out}_tokens JOIN {out}_bucket USING (term) GROUP BY ALL)"""


def _unit(source: str, key: str, out: str, dims: int = 768) -> str:
    """``key, bucket, weight``: term counts at unit length, single precision."""
    return f"""{_tf(source, key, f'{out}_tf', dims)},
{out} AS (
  SELECT {key}, bucket, (tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})))::FLOAT AS weight
  FROM {out}_tf)"""


_TF_IDF = f"""{_SILVER},
{_tf('silver', 'file_name', 'tf', 512)},
idf AS (
  SELECT bucket, ln(((SELECT count(*) FROM silver) + 1.0) / (count(*) + 1)) AS w FROM tf GROUP BY ALL)"""

_ASKED = f"""
asked AS (SELECT item_id AS question_id, text AS question,
  lower(trim({_clean('text')})) AS text_clean FROM benchmark)"""

_HITS = f"""{_SILVER},
{_ASKED},
{_unit('silver', 'file_name', 'd')},
{_unit('asked', 'question_id', 'q')},
dn AS (SELECT file_name, sqrt(sum(weight::DOUBLE * weight)) AS norm FROM d GROUP BY ALL),
qn AS (SELECT question_id, sqrt(sum(weight::DOUBLE * weight)) AS norm FROM q GROUP BY ALL),
dots AS (
  SELECT question_id, file_name, sum(d.weight::DOUBLE * q.weight) AS dot
  FROM d JOIN q USING (bucket) GROUP BY ALL),
hits AS (
  SELECT question_id, file_name,
    round(coalesce(dot, 0) / (qn.norm * dn.norm + 1e-9), 6) + 0.0 AS score,
    row_number() OVER (PARTITION BY question_id ORDER BY
      round(coalesce(dot, 0) / (qn.norm * dn.norm + 1e-9), 6) DESC, file_name) AS rank
  FROM qn CROSS JOIN dn LEFT JOIN dots USING (question_id, file_name)
  QUALIFY rank <= 3)"""

_PROMPTS = f"""{_HITS},
prompts AS (
  SELECT question_id, {_literal(PROMPT_HEAD)} || string_agg('[' || file_name || ']' || chr(10) ||
      s.text_clean, chr(10) || chr(10) ORDER BY rank) || {_literal(PROMPT_QUESTION)} || question ||
      {_literal(PROMPT_TAIL)} AS prompt
  FROM hits JOIN silver s USING (file_name) JOIN asked a USING (question_id)
  GROUP BY question_id, question)"""

# --- vectors -----------------------------------------------------------------


def _means(label: str) -> str:
    return f"""
parts AS (
  SELECT vec_id, {label} AS label, unnest(embedding)::DOUBLE AS x,
    generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS x FROM parts GROUP BY ALL),
mean_norm AS (SELECT label, sqrt(sum(x * x)) AS norm FROM means GROUP BY ALL),
vectors AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
    generate_subscripts(embedding, 1) AS pos FROM embeddings),
vector_norm AS (SELECT vec_id, label, sqrt(sum(x * x)) AS norm FROM vectors GROUP BY ALL)"""


def _mean_scores(pairs: str) -> str:
    return f"""
mean_dots AS (
  SELECT v.vec_id, m.label, sum(v.x * m.x) AS dot
  FROM vectors v JOIN means m ON v.pos = m.pos {pairs} GROUP BY ALL),
mean_scores AS (
  SELECT d.vec_id, d.label, round(dot / (m.norm * v.norm + 1e-9), 6) + 0.0 AS score
  FROM mean_dots d JOIN mean_norm m ON m.label = d.label JOIN vector_norm v ON v.vec_id = d.vec_id)"""


def _html_text(html: str) -> str:
    text = f"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"
    for name in ("head", "script", "style", "noscript"):
        text = rf"regexp_replace({text}, '(?is)<{name}\b.*?</{name}\s*>', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<[A-Za-z/!?][^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({_unescape(text)}, '{_SPACE}+', ' ', 'g'))"


def _unescape(text: str) -> str:
    pairs = (
        ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"),
        ("&nbsp;", " "), ("&amp;", "&"),
    )
    for entity, sign in pairs:
        text = f"replace({text}, '{entity}', '{sign}')"
    return text


_TITLE = (
    "trim(regexp_replace("
    + _unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    + f", '{_SPACE}+', ' ', 'g'))"
)
_LANG = "regexp_extract(html, '(?i)<html[^>]*lang=\"([A-Za-z-]+)\"', 1)"

_EXTRACTED = f"""
extracted AS (
  SELECT 'page' || page_id || '.html' AS file_name, 'text/html' AS content_type,
    {_html_text('html')} AS text_content, '' AS author, {_TITLE} AS title, '' AS created,
    {_LANG} AS language, '' AS num_pages, '2025-03-01 12:00:00' AS ingested_at
  FROM pages
  UNION ALL
  SELECT 'doc' || doc_id || '.TXT', 'text/plain', {_strip('text')}, '', '', '', '', '',
    '2025-03-01 12:00:00'
  FROM documents)"""

_MESSAGES = f"""{_CLEAN},
{_topics('clean', 'doc_id')},
classified AS (
  SELECT d.doc_id, d.source, concat(source, '/', doc_id) AS file_name, lang AS content_type,
    doc_id::VARCHAR AS title, topic,
    {_text("TIMESTAMP '2025-01-01 00:00:00' + to_seconds(doc_id)")} AS classified_at
  FROM documents d JOIN topics USING (doc_id))"""

_STAGED_COLUMNS = (
    "file_name, document_title, document_author, language, num_pages, text_length, topic, summary, "
    "content_type, " + _times("ingested_at", "processed_at", "enriched_at")
)
_GOLD_COLUMNS = (
    "file_name, content_type, title, author, language, num_pages, text_length, topic, summary, "
    + _times("ingested_at", "processed_at", "enriched_at")
)


def _fact(name: str, key: str, day: str | None, amount: str) -> str:
    newest = _text(f"max({day})") if day else "NULL::VARCHAR"
    return (
        f"SELECT '{name}' AS table_name, count(*) AS written, min({key}) AS low_key, "
        f"max({key}) AS high_key, {newest} AS newest, "
        f"round(sum({amount}::DECIMAL(38, 2))::DOUBLE, 2) AS amount FROM {name}"
    )


def oracle_sql() -> dict[str, str]:
    cut = ", ".join(
        f"substr(text, 1, {n}) AS {p}"
        for p, n in (("embed", 2048), ("summary", 1024), ("classify", 512), ("prompt", 12000))
    )
    position = (
        "CASE WHEN strpos(lower(text), 'of the') > 0 THEN strpos(lower(text), 'of the') - 1 "
        "WHEN strpos(lower(text), 'de la') > 0 THEN strpos(lower(text), 'de la') - 1 "
        "ELSE strpos(lower(text), 'der ') - 1 END"
    )
    chars = "list_distinct(regexp_extract_all(text, '(?s).'))"
    staged = f"WITH {_STAGING} SELECT {_STAGED_COLUMNS} FROM staging"
    with_stats = f"""WITH {_STATS} SELECT s.file_name, document_title, document_author, language,
      num_pages, text_length, s.topic, summary, content_type, {_times('ingested_at', 'enriched_at')},
      total_documents AS topic_total_docs, avg_text_length AS topic_avg_text_length,
      avg_pages AS topic_avg_pages FROM staging s LEFT JOIN stats t ON s.topic = t.topic"""
    return {
        "scan_files": "SELECT source, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes "
        "FROM documents GROUP BY source",
        "scan_parquet": "SELECT doc_id, lang, source, n_chars FROM documents",
        "scan_csv": f"SELECT * REPLACE ({_text('o_orderdate')} AS o_orderdate) FROM orders",
        "scan_catalog": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
        "from_rows": f"WITH {_GOLD} SELECT DISTINCT pos, label AS topic, "
        "(SELECT count(*) FROM gold g WHERE g.topic = l.label) AS docs FROM lexicon l",
        "stream_source": "SELECT concat(source, '/', doc_id) AS file_name, length(text) AS chars "
        "FROM documents",
        "write_table": f"WITH {_RAW} SELECT language, count(*) AS docs, "
        "sum(length(text_content))::BIGINT AS chars, (SELECT count(*) FROM documents) AS written "
        "FROM raw GROUP BY language",
        "upsert_by_key": "SELECT user_id, event_id, event_type, value FROM events QUALIFY "
        "row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase' DESC, ts DESC, "
        "event_id DESC) = 1",
        "stream_upsert": f"WITH {_MESSAGES} SELECT source AS file_name, content_type, title, topic, "
        "classified_at FROM classified QUALIFY row_number() OVER (PARTITION BY source "
        "ORDER BY doc_id DESC) = 1",
        "view_staging": staged,
        "table_mart": f"WITH {_STAGING} SELECT file_name, document_title, topic, text_length, "
        "num_pages FROM staging WHERE octet_length(encode(summary)) > 20",
        "project_cols": f"WITH {_SILVER} SELECT file_name, content_type, title, author, language, "
        "num_pages, text_length FROM silver",
        "add_drop_cols": "SELECT doc_id, lang AS language, n_chars, n_chars / 3000 AS chars_per_page "
        "FROM documents",
        "struct_expand": "SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events",
        "filter_min_length": f"WITH {_CLEAN} SELECT doc_id, length(text_clean) AS text_length "
        "FROM clean WHERE length(text_clean) > 50",
        "filter_not_null": f"WITH {_STAGING} SELECT file_name, num_pages, language FROM staging "
        "WHERE num_pages IS NOT NULL AND language IS NOT NULL",
        "filter_summary_length": f"WITH {_GOLD} SELECT file_name, octet_length(encode(summary)) AS "
        "summary_bytes FROM gold WHERE octet_length(encode(summary)) > 20",
        "filter_key_eq": "SELECT doc_id, source, lang, n_chars FROM documents WHERE source = 'src7'",
        "empty_text_rows": f"WITH {_RAW} SELECT file_name, 'title' AS column_name FROM raw "
        "WHERE title IS NULL OR trim(title) = '' UNION ALL SELECT file_name, 'text_content' FROM raw "
        "WHERE text_content IS NULL OR text_content = '' OR length(text_content) % 11 = 0",
        "message_faults": "SELECT doc_id AS number, CASE doc_id % 3 WHEN 0 THEN 'malformed' ELSE 'no text' END "
        "AS fault FROM documents WHERE doc_id % 3 < 2",
        "typed_clean": f"SELECT o_orderkey, o_orderstatus, o_orderpriority, {_text('o_orderdate')} "
        "AS o_orderdate FROM orders",
        "mart_by_topic": with_stats,
        "mart_rows": with_stats,
        "keyed_runs": "SELECT concat(source, '/', doc_id) AS file_name, lang, CASE WHEN doc_id % 5 = 0 "
        "THEN 4 WHEN doc_id % 7 = 0 THEN 3 WHEN doc_id % 3 <> 1 THEN 2 ELSE 1 END AS step FROM documents",
        "keyed_replays": "SELECT CAST(doc_id AS VARCHAR) AS id, source, CASE WHEN doc_id % 9 = 0 THEN 5 "
        "WHEN doc_id % 5 = 0 THEN 3 WHEN doc_id % 4 = 0 THEN 4 ELSE 6 END AS step FROM documents "
        "WHERE doc_id % 9 = 0 OR doc_id % 5 = 0 OR doc_id % 4 = 0 OR doc_id % 3 <> 0",
        "intake_runs": """
            WITH docs AS (
                SELECT source, concat(doc_id, chr(10), text) AS t FROM documents WHERE text IS NOT NULL
            ), counts AS (SELECT source, CAST(count(*) AS VARCHAR) AS t FROM docs GROUP BY source),
            sources AS (SELECT count(*) AS n FROM counts)
            SELECT source, 2::BIGINT AS files, sum(strlen(t) + 1)::BIGINT AS bytes, count(*)::BIGINT AS docs,
                any_value(n) AS new_0, 0::BIGINT AS changed_0, any_value(n) AS new_1, 0::BIGINT AS changed_1,
                0::BIGINT AS new_2, 0::BIGINT AS changed_2
            FROM (FROM docs UNION ALL FROM counts), sources GROUP BY source""",
        "train_topic_model": "SELECT CASE WHEN ('0x' || md5('42:' || doc_id)[:8])::BIGINT % 100 < 20 "
        "THEN 'test' ELSE 'train' END AS side, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS topic, "
        "count(*) AS docs, true AS at_least_majority FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
        "barrier_training": "SELECT CASE WHEN ('0x' || md5('42:' || doc_id)[:8])::BIGINT % 100 < 20 "
        "THEN 'test' ELSE 'train' END AS side, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS topic, "
        "count(*) AS docs, true AS at_least_majority, true AS same_weights FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
        "save_model": "SELECT doc_id, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS topic, "
        "true AS same FROM documents JOIN labels USING (doc_id)",
        "score_cross": f"WITH {_means('-1')}, {_mean_scores('')} SELECT vec_id, score FROM mean_scores",
        "training_set": f"WITH {_CLEAN} SELECT doc_id, text_clean, CASE WHEN quality = 1 THEN 'high' "
        "ELSE 'low' END AS topic FROM clean JOIN labels USING (doc_id)",
        "topic_stats": f"WITH {_STATS} SELECT topic, total_documents, avg_text_length, avg_pages, "
        f"{_times('first_ingested_at', 'last_ingested_at')} FROM stats",
        "row_count": 'SELECT count(*) AS "rows" FROM documents',
        "doc_frequency": f"WITH {_SILVER} SELECT term, count(DISTINCT file_name) AS df FROM "
        "(SELECT file_name, unnest(string_split(text_clean, ' ')) AS term FROM silver) GROUP BY term",
        "check_unique": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id "
        "HAVING count(*) > 1",
        "check_not_null": f"WITH {_STAGING} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM staging"
            for c in ("file_name", "topic", "summary", "language", "num_pages", "document_author")
        ),
        "topk_similar": f"WITH {_means('label')}, {_mean_scores('')} SELECT label AS question_id, "
        "vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INTEGER "
        "AS rank FROM mean_scores QUALIFY rank <= 3",
        "topk_index": f"WITH {_means('label')}, {_mean_scores('')} SELECT label AS question_id, "
        "vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INTEGER "
        "AS rank FROM mean_scores QUALIFY rank <= 3",
        "mart_summaries": f"WITH {_STAGING} SELECT file_name, document_title, document_author, topic, "
        f"language, summary, text_length, num_pages, {_times('enriched_at')} FROM staging "
        "WHERE summary IS NOT NULL AND octet_length(encode(summary)) > 20 ORDER BY enriched_at DESC",
        "report_enriched": f"WITH {_GOLD} SELECT file_name, topic, summary, {_times('enriched_at')} "
        "FROM gold ORDER BY enriched_at DESC",
        "report_topics": f"WITH {_STATS} SELECT s.topic, total_documents AS topic_total_docs, "
        "avg_text_length AS topic_avg_text_length FROM staging s LEFT JOIN stats t "
        "ON s.topic = t.topic ORDER BY topic_total_docs DESC",
        "report_bronze": f"WITH {_RAW} SELECT file_name, content_type, author, language, num_pages, "
        f"{_times('ingested_at')} FROM raw",
        "report_silver": f"WITH {_SILVER} SELECT file_name, text_length, '2025-03-01 12:00:00' AS "
        "processed_at FROM silver",
        "preview": f"WITH {_RAW} SELECT file_name, content_type, length(text_content) AS text_len, "
        "substr(text_content, 1, 200) AS text_preview FROM raw ORDER BY file_name LIMIT 10",
        "clean_text": f"SELECT doc_id, {_clean('text')} AS text_clean FROM documents",
        "lower_trim": "SELECT conv_id, turn, lower(trim(text)) AS text FROM conversations",
        "text_length": "SELECT doc_id, length(text) AS chars FROM documents",
        "stg_normalise": staged,
        "first_value_or_empty": "SELECT doc_id, coalesce(list_filter(regexp_split_to_array("
        f"lower(text), '{_NOT_WORD}'), lambda w: length(w) >= 16)[1], '') AS first_long_word "
        "FROM documents",
        "meta_fallback": "SELECT doc_id, CASE WHEN lang IN ('de', 'es') THEN source ELSE '' END "
        "AS author FROM documents",
        "truncate_text": f"SELECT doc_id, {cut}, substr(text, 1, 400) || '...' AS chat_preview, "
        "substr(text, 1, 200) AS table_preview FROM documents",
        "parse_json": "SELECT concat(source, '/', doc_id) AS file_name, text AS text_content, "
        "lang AS content_type, doc_id::VARCHAR AS title FROM documents",
        "parse_reply": f"SELECT conv_id, turn, {_strip('text')} AS first, {_strip('text')} AS second, "
        f"{_strip('text')} AS third FROM conversations",
        "now_cols": "SELECT doc_id, true AS stamped, '2025-03-01 12:00:00' AS fixed FROM documents",
        "ts_to_text": f"SELECT event_id, {_text('ts')} AS ts_text FROM events",
        "keyword_context": f"SELECT doc_id, position, CASE WHEN position >= 0 THEN substr(text, "
        "greatest(position - 200, 0) + 1, position + 600 - greatest(position - 200, 0)) END AS context "
        f"FROM (SELECT doc_id, text, ({position})::INTEGER AS position FROM documents)",
        "clean_loss_profile": "SELECT doc_id, length(text) AS chars_before, length(cleaned) AS "
        "chars_after, length(text) - length(cleaned) AS lost, (length(text) - length(cleaned)) * "
        "100.0::DOUBLE / nullif(length(text), 0) AS lost_percent, array_to_string(list_sort("
        f"list_filter({chars}, lambda c: strpos(cleaned, c) = 0)), '') AS removed "
        f"FROM (SELECT doc_id, text, {_clean('text')} AS cleaned FROM documents)",
        "lost_characters": f"SELECT character, count(*) AS texts FROM (SELECT unnest(list_filter({chars}, "
        f"lambda c: strpos(cleaned, c) = 0)) AS character FROM (SELECT text, {_clean('text')} AS cleaned "
        "FROM documents)) GROUP BY character",
        "embedding_dims": "SELECT vec_id, len(embedding) AS dims FROM embeddings",
        "cosine_score": f"WITH {_means('label')}, {_mean_scores('AND v.label = m.label')} "
        "SELECT vec_id, label, score FROM mean_scores",
        "l2_normalise": "WITH parts AS (SELECT vec_id, label, unnest(embedding)::DOUBLE * 3 + label "
        "AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) SELECT vec_id, pos, "
        "round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) + 0.0 AS x FROM parts",
        "tokenize": f"WITH {_SILVER}, parts AS (SELECT file_name, string_split(text_clean, ' ') AS t "
        "FROM silver) SELECT file_name, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS term FROM parts",
        "hashing_tf": f"WITH {_SILVER}, {_tf('silver', 'file_name', 'tf', 512)} "
        "SELECT file_name, bucket, tf::DOUBLE AS tf FROM tf",
        "tf_idf": f"WITH {_TF_IDF} SELECT file_name, bucket, round(tf * w, 6) AS weight "
        "FROM tf JOIN idf USING (bucket) WHERE tf * w <> 0",
        "term_tf_idf": f"WITH {_SILVER}, tok AS (SELECT file_name, unnest(string_split(text_clean, "
        "' ')) AS term FROM silver), tf AS (SELECT file_name, term, count(*) AS tf FROM tok GROUP BY "
        "ALL), fr AS (SELECT term, count(*) AS df FROM tf GROUP BY term) SELECT file_name, term, tf, "
        "df, round(tf * ln(((SELECT count(*) FROM silver) + 1.0) / (df + 1)), 6) + 0.0 AS tf_idf "
        "FROM tf JOIN fr USING (term)",
        "embed_documents": f"WITH {_SILVER}, {_unit('silver', 'file_name', 'd')} SELECT file_name, "
        "bucket, round(weight::DOUBLE, 6) AS weight FROM d",
        "embed_query": f"WITH {_ASKED}, {_unit('asked', 'question_id', 'q')} SELECT question_id, "
        "bucket, round(weight::DOUBLE, 6) AS weight FROM q",
        "summarise": f"WITH {_CLEAN}, {_summaries('clean', 'doc_id')} SELECT doc_id, summary "
        "FROM summaries",
        "classify_topic": f"WITH {_CLEAN}, {_topics('clean', 'doc_id')} SELECT doc_id, topic FROM topics",
        "classify_by_prototype": "WITH proto AS (SELECT label, min_by(embedding, vec_id) AS p "
        "FROM embeddings GROUP BY label) SELECT e.vec_id, t.label, "
        "round(list_dot_product(e.embedding::DOUBLE[], t.p::DOUBLE[]) / (sqrt(list_dot_product("
        "e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(t.p::DOUBLE[], "
        "t.p::DOUBLE[])) + 1e-9), 6) + 0.0 AS score FROM embeddings e CROSS JOIN proto t QUALIFY "
        "row_number() OVER (PARTITION BY e.vec_id ORDER BY score DESC, t.label) = 1",
        "encode_labels": "SELECT conv_id, turn, CASE role WHEN 'user' THEN 1 ELSE 0 END AS label_id "
        "FROM conversations",
        "extract_documents": f"WITH {_EXTRACTED} SELECT * FROM extracted",
        "extract_pages": f"SELECT url AS file_name, {_TITLE} AS title, {_LANG} AS language, "
        f"{_html_text('html')} AS text_content FROM pages",
        "extract_latin1": f"SELECT concat(doc_id, '.txt') AS file_name, {_strip('text')} AS text_content "
        "FROM documents",
        "retrieve": f"WITH {_HITS} SELECT question_id, file_name, score, rank::INTEGER AS rank FROM hits",
        "build_prompt": f"WITH {_PROMPTS} SELECT question_id, prompt FROM prompts",
        "generate_answers": f"WITH {_HITS} SELECT provider, question_id, file_name AS answer FROM hits, "
        "(VALUES ('ollama'), ('OpenAI'), ('gemini'), ('unheard-of')) p(provider) WHERE rank = 1",
        "stream_classify": f"WITH {_MESSAGES} SELECT file_name, content_type, title, topic, "
        "classified_at FROM classified",
        "stream_run": f"WITH {_MESSAGES} SELECT file_name, content_type, title, topic, classified_at "
        "FROM classified",
        "bronze": f"SELECT concat('doc_id=', doc_id) AS file_name, 'text/plain' AS content_type, {_strip('text')} AS text_content, '' AS author, "
        "'' AS title, '' AS created, '' AS language, '' AS num_pages, '2025-03-01 12:00:00' AS "
        "ingested_at FROM documents",
        "silver": f"WITH {_TF_IDF}, {_unit('silver', 'file_name', 'd')}, n AS (SELECT file_name, count(*) AS "
        "tfidf_buckets, sum(tf * w * (bucket + 1)) AS tfidf_values FROM tf JOIN idf "
        "USING (bucket) WHERE tf * w <> 0 GROUP BY file_name), e AS (SELECT file_name, "
        "sum(weight::DOUBLE * (bucket + 1)) AS embedding_values FROM d GROUP BY file_name) SELECT file_name, "
        "author, title, language, num_pages, text_clean, text_length, coalesce(tfidf_buckets, 0)::INTEGER AS "
        "tfidf_buckets, 768 AS dims, round(coalesce(tfidf_values, 0), 3) AS tfidf_values, "
        "round(embedding_values, 3) AS embedding_values FROM silver LEFT JOIN n USING (file_name) "
        "LEFT JOIN e USING (file_name)",
        "gold": f"WITH {_GOLD} SELECT {_GOLD_COLUMNS} FROM gold",
        "marts": f"WITH {_STAGING}, told AS (SELECT * FROM staging WHERE "
        "octet_length(encode(summary)) > 20) "
        + " UNION ALL ".join(
            f"SELECT '{model}' AS model, 'not_null' AS rule, '{c}' AS column_name, "
            f"count(*) FILTER ({c} IS NULL) AS failures FROM {source}"
            for model, source, columns in (
                ("stg_documents_enriched", "staging", ("file_name", "topic")),
                ("mart_documents_by_topic", "staging", ("file_name", "topic")),
                ("mart_document_summaries", "told", ("file_name", "summary")),
            )
            for c in columns
        )
        + " UNION ALL SELECT 'stg_documents_enriched', 'unique', 'file_name', "
        "count(*) - count(DISTINCT file_name) FROM staging",
        "run_layers": f"WITH {_GOLD} SELECT topic, count(*) AS topic_total_docs, count(*) AS docs, "
        "sum(text_length)::BIGINT AS chars, sum(length(summary))::BIGINT AS summary_chars "
        "FROM gold GROUP BY topic",
        "ingest_tables": " UNION ALL ".join(
            [
                _fact("orders", "o_orderkey", "o_orderdate", "o_totalprice"),
                _fact("lineitem", "l_orderkey", "l_shipdate", "l_extendedprice"),
                _fact("customer", "c_custkey", None, "c_acctbal"),
            ]
        ),
    }
