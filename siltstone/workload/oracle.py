"""The SQL that must give the same rows as each query, written for DuckDB.

The SQL is formulated on its own terms (joins and windows over token rows), not as a
translation of the DataFrame expressions.
"""

from __future__ import annotations

from siltstone.functions.predicates import DROP_WORDS
from siltstone.functions.text import ENGLISH_STOP_WORDS, VIETNAMESE_STOP_WORDS
from siltstone.operators.scoring import POSTING_FIELDS, POSTING_FIELDS_STRICT
from siltstone.workload.queries import (
    ABSENT, LAST_SEEN, LAST_SEEN_PAGE, LISTED_UNTIL, PAGE_SOURCE, READ_USERS, REPORT_PARTITIONS, RUN_LIMIT, SCORE_DIGITS, SCORED_FIELDS, SEARCH_TEXT,
)


def _strings(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


_GROUP = r"[\p{L}\p{M}]+(?:[.''’:][\p{L}\p{M}]+)*|\p{N}+(?:[.,;''’]\p{N}+)*"
_TOKEN = rf"_*(?:{_GROUP})(?:{_GROUP}|_)*"


def _tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{_TOKEN}')"


_STOP = _strings(sorted(set(ENGLISH_STOP_WORDS + VIETNAMESE_STOP_WORDS)))
_ENGLISH = _strings(ENGLISH_STOP_WORDS)
_VIETNAMESE = _strings(sorted(set(VIETNAMESE_STOP_WORDS)))


def _token_rows(table: str, key: str, column: str) -> str:
    return f"""
        SELECT {key} AS doc, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS token
        FROM (SELECT {key}, {_tokens(column)} AS tokens FROM {table})"""


def _term_rows(table: str, key: str, column: str) -> str:
    """Rows (doc, pos, kind, term) of the analysed text: kind 0 words, 1 pairs."""
    return f"""
        SELECT doc, pos, 0 AS kind, CASE WHEN regexp_full_match(w, '0|[1-9][0-9]*') THEN '' ELSE w END AS term
        FROM (SELECT doc, pos, CASE WHEN token IN ({_STOP}) THEN NULL ELSE token END AS w
              FROM ({_token_rows(table, key, column)}))
        WHERE w IS NOT NULL
        UNION ALL
        SELECT doc, pos, 1, coalesce(w || ' ' || nxt, w, nxt)
        FROM (SELECT doc, pos, w, lead(w) OVER d AS nxt, lead(pos) OVER d AS nxt_pos
              FROM (SELECT doc, pos, CASE WHEN token IN ({_STOP}) THEN NULL ELSE token END AS w
                    FROM ({_token_rows(table, key, column)}))
              WINDOW d AS (PARTITION BY doc ORDER BY pos))
        WHERE nxt_pos IS NOT NULL AND (w IS NOT NULL OR nxt IS NOT NULL)"""


def _term_counts(table: str, key: str, column: str) -> str:
    return f"""
        SELECT term, count(DISTINCT doc) AS n FROM ({_term_rows(table, key, column)}) GROUP BY term"""


def _unescape(expression: str) -> str:
    """Decode the entities of the pages; one that is cut off before its semicolon counts too."""
    for entity, char in [("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")]:
        expression = f"regexp_replace({expression}, '{entity}', '{char}', 'g')"
    return expression


def _plain(expression: str) -> str:
    return _unescape(f"regexp_replace({expression}, '<[^>]*>', '', 'g')")


_TITLE = _unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
_PAGES = f"""
    SELECT page_id, title, company,
           coalesce(paragraphs[1], '') AS overview, coalesce(paragraphs[2], '') AS requirement,
           array_to_string(paragraphs[3:], chr(10)) AS benefit, tags
    FROM (SELECT page_id, {_TITLE} AS title,
                 {_unescape("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS company,
                 list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda x: {_plain('x')}) AS tags,
                 list_transform(
                     string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')[2:],
                     lambda x: {_plain('x')}) AS paragraphs
          FROM (SELECT page_id, replace(html, chr(10), '') AS html FROM pages))"""
# The raw pages keep their newlines.
_RAW_PAGES = _PAGES.replace("replace(html, chr(10), '') AS html", "html")

_TAGS = "SELECT unnest(string_split(p_name, ' ')) AS tag FROM part"
_TAG_COUNT = f"SELECT tag, count(*) AS tag_post_count FROM ({_TAGS}) GROUP BY tag"
_TAG_TERMS = f"""
    SELECT term, count(DISTINCT p_partkey) AS n
    FROM (SELECT p_partkey, unnest({_tokens('p_name')}) AS term FROM part) GROUP BY term"""
_PAGE_TAGS = f"SELECT page_id, unnest(tags) AS tag FROM ({_RAW_PAGES})"

_DICTIONARY = f"SELECT unnest({_tokens('text')}) AS term FROM benchmark"


def _admissible(term: str) -> str:
    return f"""NOT (
        (position(' ' IN {term}) = 0 AND strlen({term}) <> length({term}))
        OR list_has_any(string_split({term}, ' '), [{_strings(DROP_WORDS)}])
        OR regexp_full_match({term}, '\\p{{N}}+'))"""


_FIELD_COUNTS = {
    "tags": _TAG_TERMS,
    "document": _term_counts("documents", "doc_id", "text"),
    "conversation": _term_counts(
        "(SELECT row_number() OVER () AS row_id, text FROM conversations)", "row_id", "text"
    ),
    "title": _term_counts(f"(SELECT page_id, title FROM ({_RAW_PAGES}))", "page_id", "title"),
}


def _points(field_counts: dict[str, str], fields, buckets: int | None = None) -> str:
    cut = f" ORDER BY n DESC, term LIMIT {buckets}" if buckets else ""
    union = " UNION ALL ".join(
        f"""SELECT term, {field.weight} * n AS points, {field.name == fields[0].name} AS is_tag
            FROM (SELECT term, n FROM ({field_counts[field.name]}) WHERE n >= {field.min_doc_count}{cut})"""
        for field in fields
    )
    return f"SELECT term, CAST(sum(points) AS BIGINT) AS points, bool_or(is_tag) AS is_tag FROM ({union}) GROUP BY term"


def _classes(points: str) -> str:
    return f"""
        SELECT term, points, CASE
            WHEN is_tag OR (ok AND term IN (SELECT term FROM ({_DICTIONARY}))) THEN 'TAG'
            WHEN ok THEN 'NOT_TAG' ELSE 'IGNORED' END AS class
        FROM (SELECT *, {_admissible('term')} AS ok FROM ({points}))"""


_SCORING = _classes(_points(_FIELD_COUNTS, SCORED_FIELDS))

_POSTING_COUNTS = {
    "tags": f"""SELECT term, count(DISTINCT page_id) AS n
                FROM (SELECT page_id, unnest({_tokens('tag')}) AS term FROM ({_PAGE_TAGS})) GROUP BY term""",
    **{name: _term_counts(f"(SELECT page_id, {name} FROM ({_RAW_PAGES}))", "page_id", name)
       for name in ("overview", "requirement", "benefit")},
}

_DOC_TERM_COUNTS = _FIELD_COUNTS["document"]
_DOC_TERMS = f"SELECT DISTINCT term FROM ({_term_rows('documents', 'doc_id', 'text')})"

_EVENT_HEADER = """
    CASE WHEN user_id % 11 = 0 THEN NULL
         WHEN user_id % 7 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE CAST(user_id AS VARCHAR) END"""
_BRONZE = f"""
    SELECT CAST(to_json(props) AS VARCHAR) AS value, event_id % 4 AS partition, event_id // 4 AS "offset",
           ts AS timestamp, 0 AS "timestampType", event_type AS source,
           CAST(TRY_CAST({_EVENT_HEADER} AS INTEGER) AS VARCHAR) AS collect_id
    FROM events"""

_ORDER_PAGES = """
    SELECT CAST(-date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS page,
           o_orderkey AS pos, o_orderkey AS id
    FROM orders"""


def _since(rows: str, marker: int | str, row_id: str = "id") -> str:
    return f"""
        WITH rows AS ({rows}), seen AS (SELECT page, pos FROM rows WHERE {row_id} = {marker!r} ORDER BY page, pos LIMIT 1)
        SELECT rows.* FROM rows LEFT JOIN seen ON TRUE
        WHERE seen.pos IS NULL OR rows.page < seen.page OR (rows.page = seen.page AND rows.pos < seen.pos)"""


def _content_id(*fields: str) -> str:
    text = " || ".join(f"substring({field}, 1, 10)" for field in fields)
    total = "0::HUGEINT"
    for start in range(1, 41, 8):
        total = f"({total} * 4294967296 + ('0x' || substring(h, {start}, 8))::HUGEINT) % 100000000"
    return f"(SELECT CAST({total} AS BIGINT) FROM (SELECT sha1({text}) AS h))"


_COLLECTED = f"""
    SELECT CAST(page_id // 20 AS INTEGER) AS page, CAST(page_id % 20 AS INTEGER) AS pos,
           {_content_id('title', 'company', 'requirement', 'benefit', 'overview')} AS id,
           sha256(concat_ws(chr(31), title, company, requirement, benefit, overview)) AS digest,
           requirement = '' OR overview = '' OR benefit = '' AS abnormal, replace(html, chr(10), '') AS raw
    FROM ({_PAGES}) JOIN pages USING (page_id)"""


def _frequency_table(counts: str, limit: int | None = None) -> str:
    cut = f" ORDER BY id LIMIT {limit}" if limit else ""
    return f"""
        SELECT id, term, n, printf('%3d|"%-15s"|%-5d|', id, term, n) AS line
        FROM (SELECT row_number() OVER (ORDER BY n DESC, term) AS id, term, n FROM ({counts})){cut}"""


def _relative(counts: str) -> str:
    return f"""
        SELECT term, n, round(n / max(n) OVER (), {SCORE_DIGITS}) AS weight
        FROM (SELECT term, n FROM ({counts}))"""


_SEARCH = f"""
    WITH rows AS MATERIALIZED ({_term_rows('documents', 'doc_id', 'text')}),
    query AS (SELECT DISTINCT term FROM ({_term_rows(f"(SELECT 1 AS q, '{SEARCH_TEXT}' AS text)", 'q', 'text')})),
    lengths AS (SELECT doc, count(*) AS len FROM rows GROUP BY doc),
    corpus AS (SELECT count(*) AS docs, avg(len) AS avg_len FROM lengths),
    tf AS (SELECT doc, term, count(*) AS tf FROM rows WHERE term IN (SELECT term FROM query) GROUP BY doc, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT doc AS doc_id, round(score, {SCORE_DIGITS}) AS score
    FROM (SELECT tf.doc, sum(ln(1 + (docs - df + 0.5) / (df + 0.5))
                            * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * len / avg_len))) AS score
          FROM tf JOIN df USING (term) JOIN lengths USING (doc), corpus GROUP BY tf.doc
          ORDER BY score DESC, tf.doc LIMIT 10)"""

_SEARCH_MANY = f"""
    WITH rows AS MATERIALIZED ({_term_rows('documents', 'doc_id', 'text')}),
    query AS (SELECT DISTINCT doc AS query_id, term FROM ({_term_rows('benchmark', 'item_id', 'text')})),
    lengths AS (SELECT doc, count(*) AS len FROM rows GROUP BY doc),
    corpus AS (SELECT count(*) AS docs, avg(len) AS avg_len FROM lengths),
    tf AS (SELECT doc, term, count(*) AS tf FROM rows WHERE term IN (SELECT term FROM query) GROUP BY doc, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    parts AS (SELECT query_id, doc, term, ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * len / avg_len)) AS part
              FROM query JOIN tf USING (term) JOIN df USING (term) JOIN lengths USING (doc), corpus),
    scores AS (SELECT query_id, doc, list_reduce(list(part ORDER BY term), lambda a, b: a + b) AS score FROM parts GROUP BY query_id, doc)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, doc AS doc_id, round(score, {SCORE_DIGITS}) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM scores)
    WHERE rank <= 10"""

_SILVER = f"""
    SELECT (page_id % 4) * 1000000000 + page_id // 4 AS id, '{PAGE_SOURCE}' AS source,
           CAST(page_id AS INTEGER) AS collect_id, title, array_to_string(tags, '|') AS tags,
           overview, requirement, benefit, company
    FROM ({_PAGES})"""


_ANALYSED = f"""
        SELECT doc_id, CAST(coalesce(terms, 0) AS INTEGER) AS terms,
               CAST(coalesce(distinct_terms, 0) AS INTEGER) AS distinct_terms
        FROM documents LEFT JOIN (
            SELECT doc, count(*) AS terms, count(DISTINCT term) AS distinct_terms
            FROM ({_term_rows('documents', 'doc_id', 'text')}) GROUP BY doc) ON doc = doc_id"""


ORACLE: dict[str, str] = {
    "bronze_projection": _BRONZE,
    "raw_values": f"SELECT value FROM ({_BRONZE})",
    "surrogate_id": """
        SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
               (event_id % 4) * 1000000000 + event_id // 4 AS id FROM events""",
    "payload_decode": "SELECT doc_id, text FROM documents",
    "json_to_columns": """
        SELECT event_id, CAST(props->>'k' AS INTEGER) AS k, CAST(json(props) AS VARCHAR) AS encoded FROM events""",
    "html_extract": f"""
        SELECT page_id, '{PAGE_SOURCE}' AS source, title, array_to_string(tags, '|') AS tags,
               overview, requirement, benefit, company
        FROM ({_RAW_PAGES})""",
    "newline_strip": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
    "abnormal_records": f"SELECT page, pos, id, abnormal FROM ({_COLLECTED})",
    "content_id": f"SELECT p_partkey, {_content_id('p_name', 'p_brand', 'p_type')} AS id FROM part",
    "row_label": """
        SELECT p_partkey, printf('%8d | %-40s | %-20s', p_partkey, p_name[1:40], p_brand[1:20]) AS label FROM part""",
    "tag_count": _TAG_COUNT,
    "company_count": """
        SELECT c_mktsegment AS company, count(*) AS company_post_count FROM customer GROUP BY c_mktsegment""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "keyword_count": "SELECT source AS term, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source",
    "frequency_table": _frequency_table(f"SELECT tag AS term, tag_post_count AS n FROM ({_TAG_COUNT})"),
    "frequency_table_top": _frequency_table(_DOC_TERM_COUNTS, 200),
    "frequency_map": f"SELECT tag, tag_post_count AS n FROM ({_TAG_COUNT})",
    "tokenize": f"""
        SELECT doc AS doc_id, CAST(pos AS INTEGER) AS pos, token
        FROM ({_token_rows('documents', 'doc_id', 'text')})""",
    "token_word_count": "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words FROM part",
    "stopwords_english": f"""
        SELECT doc_id, array_to_string(list_transform({_tokens('text')},
            lambda t: CASE WHEN t IN ({_ENGLISH}) THEN '_' ELSE t END), ' ') AS kept FROM documents""",
    "stopwords_vietnamese": f"""
        SELECT doc_id, array_to_string(list_transform({_tokens('text')},
            lambda t: CASE WHEN t IN ({_VIETNAMESE}) THEN '_' ELSE t END), ' ') AS kept FROM documents""",
    "shingles": f"""
        SELECT doc AS doc_id, CAST(pos AS INTEGER) AS pos, term AS pair
        FROM ({_term_rows('documents', 'doc_id', 'text')}) WHERE kind = 1""",
    "number_blank": f"""
        SELECT token AS term, trim(regexp_replace(token, '^(0|[1-9][0-9]*)$', '')) AS blanked, count(*) AS n
        FROM ({_token_rows('documents', 'doc_id', 'text')}) GROUP BY token""",
    "analyze_text": f"""
        SELECT doc AS item_id, CAST(row_number() OVER (PARTITION BY doc ORDER BY pos, kind) - 1 AS INTEGER) AS pos, term
        FROM ({_term_rows('benchmark', 'item_id', 'text')})""",
    "tag_terms": _TAG_TERMS,
    "term_count": _DOC_TERM_COUNTS,
    "term_count_min3": f"SELECT * FROM ({_DOC_TERM_COUNTS}) WHERE n >= 3",
    "term_count_min10": f"SELECT * FROM ({_DOC_TERM_COUNTS}) WHERE n >= 10",
    "frequent_terms": f"SELECT * FROM ({_DOC_TERM_COUNTS}) WHERE n >= 10",
    "term_buckets": f"SELECT * FROM ({_DOC_TERM_COUNTS}) ORDER BY n DESC, term LIMIT 10000",
    "term_top": f"SELECT * FROM ({_DOC_TERM_COUNTS}) ORDER BY n DESC, term LIMIT 100",
    "word_frequency": f"""
        SELECT token AS term, count(*) AS n FROM ({_token_rows('documents', 'doc_id', 'text')}) GROUP BY token""",
    "word_frequency_stop": f"""
        SELECT token AS term, count(*) AS n FROM ({_token_rows('documents', 'doc_id', 'text')})
        WHERE token NOT IN ({_ENGLISH}) GROUP BY token""",
    "most_frequent": f"""
        SELECT token AS term, count(*) AS n FROM ({_token_rows('documents', 'doc_id', 'text')})
        GROUP BY token ORDER BY n DESC, term LIMIT 1""",
    "relative_weight": _relative(_DOC_TERM_COUNTS),
    "match_search": _SEARCH,
    "match_search_stored": _SEARCH,
    "match_search_many": _SEARCH_MANY,
    "weighted_points": f"SELECT term, points FROM ({_points(_FIELD_COUNTS, SCORED_FIELDS)})",
    "weighted_points_buckets": f"SELECT term, points FROM ({_points(_FIELD_COUNTS, SCORED_FIELDS, 10000)})",
    "term_scoring": _SCORING,
    "tag_points": f"SELECT term, points FROM ({_SCORING}) WHERE class = 'TAG'",
    "other_points": f"SELECT term, points FROM ({_SCORING}) WHERE class = 'NOT_TAG'",
    "posting_scores": _classes(_points(_POSTING_COUNTS, POSTING_FIELDS)),
    "posting_scores_stored": _classes(_points(_POSTING_COUNTS, POSTING_FIELDS)),
    "posting_scores_strict": _classes(_points(_POSTING_COUNTS, POSTING_FIELDS_STRICT)),
    "tag_points_table": _frequency_table(f"SELECT term, points AS n FROM ({_SCORING}) WHERE class = 'TAG'"),
    "other_points_table": _frequency_table(f"SELECT term, points AS n FROM ({_SCORING}) WHERE class = 'NOT_TAG'"),
    "term_flags": f"""
        SELECT term, position(' ' IN term) = 0 AND strlen(term) <> length(term) AS single_non_ascii,
               list_has_any(string_split(term, ' '), [{_strings(DROP_WORDS)}]) AS drop_word,
               regexp_full_match(term, '\\p{{N}}+') AS number, {_admissible('term')} AS admissible
        FROM ({_DOC_TERMS})""",
    "terms_allowed": f"""
        SELECT term FROM ({_DOC_TERMS}) WHERE {_admissible('term')} AND term IN (SELECT term FROM ({_DICTIONARY}))""",
    "terms_dropped": f"""
        SELECT term FROM ({_DOC_TERMS})
        WHERE {_admissible('term')} AND term NOT IN (SELECT term FROM ({_DICTIONARY}))""",
    "dictionary_duplicates": f"SELECT term, count(*) AS n FROM ({_DICTIONARY}) GROUP BY term HAVING count(*) > 1",
    "dictionary_sorted": f"SELECT term FROM ({_DICTIONARY}) ORDER BY term",
    "batch_concat": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS page, o_orderkey AS pos, o_totalprice
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "page_max": """
        SELECT max(CAST(label AS BIGINT)) AS page_num
        FROM (SELECT regexp_extract(url, 'page=([^&#]*)', 1) AS label FROM pages)
        WHERE regexp_full_match(label, '[0-9]+')""",
    "latest_limit": f"SELECT * FROM ({_ORDER_PAGES}) ORDER BY page, pos LIMIT {RUN_LIMIT}",
    "since_marker": _since(_ORDER_PAGES, LAST_SEEN),
    "since_marker_absent": _since(_ORDER_PAGES, ABSENT),
    "new_rows": _since(f"SELECT * FROM ({_ORDER_PAGES}) ORDER BY page, pos LIMIT {RUN_LIMIT}", LAST_SEEN),
    "limited_runs": f"""
        WITH orders_ AS (SELECT *, (SELECT count(*) // 4 FROM orders) AS quarter FROM ({_ORDER_PAGES})),
             first_ AS (SELECT id FROM orders_ WHERE page > -{LISTED_UNTIL[0]} QUALIFY row_number() OVER (ORDER BY page, pos) <= quarter),
             second_ AS (SELECT id FROM orders_ WHERE page > -{LISTED_UNTIL[1]} AND id NOT IN (SELECT id FROM first_)
                         QUALIFY row_number() OVER (ORDER BY page, pos) <= quarter)
        SELECT id, CAST(CASE WHEN id IN (SELECT id FROM first_) THEN 1 WHEN id IN (SELECT id FROM second_) THEN 2 ELSE 3 END AS INTEGER) AS run
        FROM orders_""",
    "high_water_mark": f"SELECT id AS marker FROM ({_ORDER_PAGES}) ORDER BY page, pos LIMIT 1",
    "keyed_upsert": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id
            ORDER BY event_type IN ('signup', 'error', 'click'), event_id DESC) = 1""",
    "keyed_point_read": f"""
        SELECT user_id, event_id, event_type, value FROM events WHERE user_id IN ({', '.join(map(str, READ_USERS))})
        QUALIFY row_number() OVER (PARTITION BY user_id
            ORDER BY event_type IN ('signup', 'error', 'click'), event_id DESC) = 1""",
    "analysed_changes": _ANALYSED,
    "analysed_copy": _ANALYSED,
    "stream_bronze": _BRONZE,
    "stream_tag_count": _TAG_COUNT,
    "stream_tag_update": _TAG_COUNT,
    "stream_row_count": "SELECT count(*) AS row_count FROM lineitem",
    "stream_keyed_upsert": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "stream_keyed_compacted": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "medallion_flow": _relative(f"SELECT tag AS term, count(*) AS n FROM ({_PAGE_TAGS}) GROUP BY tag"),
    "medallion_silver": _SILVER,
    "medallion_together": _SILVER,
    "medallion_together_weights": _relative(f"SELECT tag AS term, count(*) AS n FROM ({_PAGE_TAGS}) GROUP BY tag"),
    "medallion_index": _SILVER,
    "integration_messages": f"""
        SELECT md5(raw) AS raw_md5, 'source' AS header1, 'message_group_id' AS header2,
               '{PAGE_SOURCE}' AS value1, 'run 1' AS value2
        FROM ({_since(_COLLECTED, LAST_SEEN_PAGE, "digest")})""",
    "table_rows": "SELECT count(*) AS row_count FROM lineitem",
    "table_partitions": f"SELECT CAST({REPORT_PARTITIONS} AS BIGINT) AS partitions, count(*) AS row_count FROM lineitem",
}
