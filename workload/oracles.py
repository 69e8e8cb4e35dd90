"""The SQL each query is checked against, over the same tables."""

from __future__ import annotations

NL = "chr(10)"

# one row per line of a document: position i, page p, position in the page k
LINES = f"""WITH raw AS (
  SELECT doc_id, lang, source, unnest(string_split(text, {NL})) AS t,
         generate_subscripts(string_split(text, {NL}), 1) - 1 AS i
  FROM documents),
l AS (
  SELECT doc_id, lang, source, t, i, CAST(i // 4 AS INTEGER) AS p, i % 4 AS k,
         CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS n,
         CAST(ceil(count(*) OVER (PARTITION BY doc_id) / 4.0) AS INTEGER) AS pages
  FROM raw),
pg AS (
  SELECT doc_id, p, any_value(pages) AS pages, CAST(count(*) AS INTEGER) AS c,
         string_agg('missing required field ''text'' in lines[' || i || ']', ', ' ORDER BY i) FILTER (WHERE length(t) % 7 = 0) AS bad
  FROM l GROUP BY doc_id, p)
"""

UPPER = "upper(replace({}, 'ß', 'SS'))"


def _counters(where: str = "") -> str:
    return f"""SELECT doc_id, p AS page_index, 'index' AS path, 'INT' AS leaf_type, CAST(p AS VARCHAR) AS value FROM pg {where}
UNION ALL SELECT doc_id, p, 'total', 'INT', CAST(pages AS VARCHAR) FROM pg {where}
UNION ALL SELECT doc_id, p, 'count', 'INT', CAST(c AS VARCHAR) FROM pg {where}"""


def _items(array: str, text: str = "t", lang: str = "lang", where: str = "TRUE") -> str:
    return f"""SELECT doc_id, p AS page_index, '{array}.' || k || '.n' AS path, 'BIGINT' AS leaf_type, CAST(i AS VARCHAR) AS value FROM l WHERE {where}
UNION ALL SELECT doc_id, p, '{array}.' || k || '.chars', 'BIGINT', CAST(length(t) AS VARCHAR) FROM l WHERE {where}
UNION ALL SELECT doc_id, p, '{array}.' || k || '.lang', 'STRING', {lang} FROM l WHERE {where}
UNION ALL SELECT doc_id, p, '{array}.' || k || '.text', 'STRING', {text} FROM l WHERE length(t) % 7 <> 0 AND {where}"""


def _event_leaves(kind: str = "event_type") -> str:
    return f"""SELECT event_id, 'id' AS path, 'BIGINT' AS leaf_type, CAST(event_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'type', 'STRING', {kind} FROM events
UNION ALL SELECT event_id, 'user.id', 'BIGINT', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'value', 'DOUBLE', CAST(value AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'props.k', 'BIGINT', json_extract_string(props, '$.k') FROM events"""


def _line_leaves(flag: str = "{}") -> str:
    key = "l_orderkey, l_linenumber, l_partkey"
    parts = [
        ("order.id", "BIGINT", "CAST(l_orderkey AS VARCHAR)"),
        ("line.n", "BIGINT", "CAST(l_linenumber AS VARCHAR)"),
        ("line.part.id", "BIGINT", "CAST(l_partkey AS VARCHAR)"),
        ("line.part.supplier", "BIGINT", "CAST(l_suppkey AS VARCHAR)"),
        ("line.qty", "DOUBLE", "CAST(l_quantity AS VARCHAR)"),
        ("line.price", "DOUBLE", "CAST(l_extendedprice AS VARCHAR)"),
        ("line.flags.0", "STRING", flag.format("l_returnflag")),
        ("line.flags.1", "STRING", flag.format("l_linestatus")),
    ]
    return "\nUNION ALL ".join(
        f"SELECT {key}, '{path}' AS path, '{kind}' AS leaf_type, {value} AS value FROM lineitem" for path, kind, value in parts
    )


def _turns(kind: str, value: str, where: str = "TRUE") -> str:
    return f"""WITH l AS (
  SELECT conv_id, turn, unnest(string_split(text, {NL})) AS t, generate_subscripts(string_split(text, {NL}), 1) - 1 AS i
  FROM conversations)
SELECT conv_id, turn, 'conversation.id' AS path, 'BIGINT' AS leaf_type, CAST(conv_id AS VARCHAR) AS value FROM conversations
UNION ALL SELECT conv_id, turn, 'conversation.turn', 'BIGINT', CAST(turn AS VARCHAR) FROM conversations
UNION ALL SELECT conv_id, turn, 'role', 'STRING', role FROM conversations
UNION ALL SELECT conv_id, turn, 'parts.' || i || '.n', 'BIGINT', CAST(i AS VARCHAR) FROM l
UNION ALL SELECT conv_id, turn, 'parts.' || i || '.text', CASE WHEN length(t) % 3 = 0 THEN {kind} ELSE 'STRING' END,
  CASE WHEN length(t) % 3 = 0 THEN {value} ELSE t END FROM l WHERE {where}"""


_FAULT = "CASE event_type WHEN 'signup' THEN 'EMPTY' WHEN 'error' THEN 'PARSE' END"
_MESSAGE = "CASE event_type WHEN 'signup' THEN 'Empty or null message' WHEN 'error' THEN 'Malformed JSON message' END"
_NO_USER = "'Input schema validation failed: [missing required field ''user'''"


def _events_checked(no_user: str, others: str) -> str:
    return f"""SELECT event_id,
  CASE WHEN event_type IN ('signup', 'error') THEN {_FAULT}
       WHEN event_type = 'view' THEN 'REQUIRED' WHEN {others} IS NOT NULL THEN 'REQUIRED' END AS error_code,
  CASE WHEN event_type IN ('signup', 'error') THEN {_MESSAGE}
       WHEN event_type = 'view' THEN {no_user} ELSE {others} END AS error_message
FROM events"""


_EVENT_JSON = """'{"id":' || event_id || ',"props":{"k":' || json_extract_string(props, '$.k') || '},"type":"' || {kind} ||
  '","user":{"id":' || user_id || '},"value":' || value || '}'"""

_FAULTY_JSON = """CASE event_type WHEN 'signup' THEN ''
  WHEN 'error' THEN '{"id":' || event_id || ',"type":"error","user":{"id":' || user_id || '},"value":' || value || ',"props":' || props
  WHEN 'view' THEN '{"id":' || event_id || ',"type":"view","value":' || value || ',"props":' || props || '}' END"""

_LETTERS = f"""SELECT event_id, {_FAULTY_JSON} AS original,
    CASE WHEN event_type = 'view' THEN 'REQUIRED' ELSE {_FAULT} END AS code,
    CASE WHEN event_type = 'view' THEN {_NO_USER} || ']' ELSE {_MESSAGE} END AS message
  FROM events WHERE event_type IN ('signup', 'error', 'view')"""


def _csv(field: str) -> str:
    return (
        f"CASE WHEN regexp_matches({field}, '[,\"\\n\\r]') THEN '\"' || replace({field}, '\"', '\"\"') || '\"' ELSE {field} END"
    )


# documents of which every line has a text
_WHOLE = "doc_id NOT IN (SELECT doc_id FROM pg WHERE bad IS NOT NULL)"

ORACLES: dict[str, str] = {
    "envelope_headers": """SELECT event_id, 'type' AS name, event_type AS content FROM events
UNION ALL SELECT event_id, 'user', CAST(user_id AS VARCHAR) FROM events""",
    "parse_guard": f"SELECT event_id, {_FAULT} AS error_code FROM events",
    "parse_lenient": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'PARSE' END AS error_code,
  CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events""",
    "required_paths": _events_checked(
        f"{_NO_USER} || ', missing required field ''trace'']'",
        "'Input schema validation failed: [missing required field ''trace'']'",
    ),
    "required_by_schema": _events_checked(f"{_NO_USER} || ']'", "CAST(NULL AS VARCHAR)"),
    "items_by_page": LINES
    + """SELECT doc_id, p AS page_index, pages AS total_pages, c AS item_count,
  CASE WHEN bad IS NOT NULL THEN 'ITEM_REQUIRED' END AS error_code,
  'Item validation failed: [' || bad || ']' AS error_message FROM pg""",
    "whole_messages": LINES
    + """SELECT doc_id, 'REQUIRED' AS error_code, 'Required field validation failed: [missing top-level field ''author''' ||
  coalesce(', ' || string_agg('missing field ''text'' in lines[' || i || ']', ', ' ORDER BY i) FILTER (WHERE length(t) % 7 = 0), '') || ']'
  AS error_message FROM l GROUP BY doc_id""",
    "page_slices": LINES
    + """SELECT doc_id, p AS page_index, pages AS total_pages, c AS item_count, c AS n_items,
  (SELECT CASE WHEN length(t) % 7 <> 0 THEN t END FROM l WHERE l.doc_id = pg.doc_id AND l.p = pg.p AND k = 0) AS first_text FROM pg""",
    # shapes by remainder: 0 array, 1 object, 2 empty object, 3 text, 4 number, 5 null, 6 empty array, 7 missing
    "array_policy": """SELECT event_id, policy, CASE WHEN event_id % 8 = 0 THEN 0 ELSE -1 END AS page_index,
  CASE WHEN event_id % 8 = 0 THEN 2 ELSE -1 END AS item_count, CASE WHEN event_id % 8 <> 0 THEN 'NOT_ARRAY' END AS error_code
FROM events, (VALUES ('dlq'), ('drop')) AS p(policy) WHERE event_id % 8 IN (0, 1) OR policy = 'dlq' AND event_id % 8 <> 6""",
    "message_account": """SELECT count(*) FILTER (WHERE event_id % 8 = 0) AS first_pages, 2 * count(*) FILTER (WHERE event_id % 8 = 0) AS pages,
  count(*) FILTER (WHERE event_id % 8 NOT IN (0, 6)) AS letters FROM events""",
    "deep_leaves": """SELECT event_id, repeat('n.', CAST(event_id % 40 AS INTEGER)) || 'leaf' AS path, 'BIGINT' AS leaf_type,
  CAST(event_id AS VARCHAR) AS value FROM events""",
    "typed_leaves": """SELECT event_id, 'flag' AS path, 'BOOLEAN' AS leaf_type, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS value FROM events
UNION ALL SELECT event_id, 'wide', 'DECIMAL(28,0)', '1234567890123456789' || lpad(CAST(event_id AS VARCHAR), 9, '0') FROM events
UNION ALL SELECT event_id, 'part', 'DOUBLE', '0.5' FROM events
UNION ALL SELECT event_id, 'none', 'VOID', NULL FROM events""",
    "page_letters": LINES
    + """SELECT doc_id, CASE WHEN bad IS NOT NULL THEN 'ITEM_REQUIRED' ELSE 'GAP' END AS error_code, TRUE AS whole
FROM pg WHERE bad IS NOT NULL OR doc_id % 7 = 3 AND p = 0""",
    "later_fields": """WITH e AS (SELECT *, event_id % 5 = 0 AS both_, event_id % 2 = 0 AS even FROM events)
SELECT event_id, 'id' AS path, 'BIGINT' AS leaf_type, CAST(event_id AS VARCHAR) AS value FROM e
UNION ALL SELECT event_id, 'user.id', CASE WHEN both_ AND even THEN 'STRING' ELSE 'BIGINT' END,
  CASE WHEN both_ AND even THEN event_type ELSE CAST(user_id AS VARCHAR) END FROM e
UNION ALL SELECT event_id, 'user.z.0.y.x', 'BIGINT', '1' FROM e WHERE both_
UNION ALL SELECT event_id, 'user.z.1', 'BIGINT', '2' FROM e WHERE both_""",
    "odd_page_leaves": LINES
    + f"""SELECT * FROM ({_counters("WHERE bad IS NULL")}
UNION ALL {_items("lines", where="(doc_id, p) IN (SELECT (doc_id, p) FROM pg WHERE bad IS NULL)")}
UNION ALL SELECT doc_id, p, 'lines.0.a.b', 'BIGINT', '2' FROM pg WHERE bad IS NULL AND p = 0 AND doc_id % 5 = 0)
WHERE NOT (doc_id % 7 = 3 AND page_index = 0)""",
    "entry_rejects": """SELECT event_id, event_id AS no, i AS entry_index, CAST(CASE WHEN i = 0 THEN 1 ELSE -1 END AS BIGINT) AS k, CASE WHEN i = 1 THEN 'TYPE' END AS error_code
FROM events, (VALUES (CAST(0 AS INTEGER)), (CAST(1 AS INTEGER))) AS e(i) WHERE event_id % 8 = 0
UNION ALL SELECT event_id, event_id, -1, -1, 'NOT_ARRAY' FROM events WHERE event_id % 8 NOT IN (0, 6)""",
    "page_json": LINES
    + """SELECT doc_id, '{"page":' || p || ',"pages":' || any_value(pages) || ',"size":' || count(*) || ',"rows":[' ||
  string_agg('{"n":' || i || ',"chars":' || length(t) || ',"lang":"' || lang || '"' ||
    CASE WHEN length(t) % 7 = 0 THEN '' ELSE ',"text":' || CAST(to_json(t) AS VARCHAR) END || '}', ',' ORDER BY i) || ']}' AS page_json
FROM l GROUP BY doc_id, p""",
    "event_leaves": _event_leaves(),
    "line_leaves": _line_leaves(),
    "page_leaves": LINES + _counters() + "\nUNION ALL " + _items("rows"),
    "nulls_included": _turns("'VOID'", "NULL"),
    "nulls_excluded": _turns("'VOID'", "NULL", "length(t) % 3 <> 0"),
    "nulls_as_text": _turns("'STRING'", "''"),
    "wildcard_upper": LINES + _counters() + "\nUNION ALL " + _items("lines", UPPER.format("t")),
    "exact_upper": _event_leaves("upper(event_type)"),
    "udf_reverse": _line_leaves("'!' || {}"),
    "leaf_counters": LINES
    + """SELECT CAST(sum(f) AS BIGINT) AS fields_processed, count(*) FILTER (WHERE f = 0) AS no_match
FROM (SELECT count(*) FILTER (WHERE length(t) % 7 <> 0) AS f FROM l GROUP BY doc_id, p)""",
    "mapped_fields": LINES
    + """SELECT doc_id, p AS page_index, 'index' AS path, 'INT' AS leaf_type, CAST(p AS VARCHAR) AS value FROM pg
UNION ALL SELECT doc_id, p, 'rows.' || k || '.body', 'STRING', t FROM l WHERE length(t) % 7 <> 0
UNION ALL SELECT doc_id, p, 'rows.' || k || '.label', 'STRING', lang || ': ' || t || ' of ' || pages FROM l WHERE length(t) % 7 <> 0""",
    "entry_rows": LINES
    + """SELECT doc_id, source AS doc_source, CAST(i AS INTEGER) AS entry_index, CAST(i AS BIGINT) AS line_no,
  CASE WHEN length(t) % 7 <> 0 THEN t END AS line_text FROM l""",
    "entry_types": LINES
    + """SELECT doc_id, lang AS doc_lang, CAST(i AS INTEGER) AS entry_index, CAST(i AS BIGINT) AS n, CAST(length(t) AS DOUBLE) AS length,
  CASE WHEN length(t) % 7 <> 0 THEN t END AS text, CAST(NULL AS BOOLEAN) AS absent FROM l""",
    "declared_mapping": LINES
    + """SELECT doc_id, p AS page_index, 'no' AS path, 'INT' AS leaf_type, CAST(p AS VARCHAR) AS value FROM pg
UNION ALL SELECT doc_id, p, 'of', 'INT', CAST(pages AS VARCHAR) FROM pg
UNION ALL SELECT doc_id, p, 'body.' || k || '.words', 'STRING', t FROM l WHERE length(t) % 7 <> 0
UNION ALL SELECT doc_id, p, 'body.' || k || '.head', 'STRING', lang || '#' || p FROM l""",
    "rebuilt_events": f"SELECT event_id, {_EVENT_JSON.replace('{kind}', 'event_type')} AS json, CAST(NULL AS VARCHAR) AS error_code FROM events",
    "rebuilt_lines": """SELECT l_orderkey, l_linenumber, l_partkey, '{"line":{"flags":["' || l_returnflag || '","' || l_linestatus ||
  '"],"n":' || l_linenumber || ',"part":{"id":' || l_partkey || ',"supplier":' || l_suppkey || '},"price":' || l_extendedprice ||
  ',"qty":' || l_quantity || '},"order":{"id":' || l_orderkey || '}}' AS json, CAST(NULL AS VARCHAR) AS error_code FROM lineitem""",
    "path_conflicts": """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN '{"list":[' || c_custkey || ',{"x":7}],"name":{"nation":' ||
  c_nationkey || '},"seg":{"k":"' || c_mktsegment || '"},"tags":[null,null,' || c_acctbal || ']}' END AS json,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONFLICT' END AS error_code FROM customer""",
    "round_trip": "SELECT count(*) AS messages, CAST(0 AS BIGINT) AS different FROM lineitem",
    "csv_encoded": f"SELECT doc_id, doc_id || ',' || {_csv('lang')} || ',' || {_csv('text')} || ',' AS csv FROM documents",
    "csv_decoded": """SELECT doc_id, 'id' AS path, 'STRING' AS leaf_type, CAST(doc_id AS VARCHAR) AS value FROM documents
UNION ALL SELECT doc_id, 'lang', 'STRING', lang FROM documents
UNION ALL SELECT doc_id, 'text', 'STRING', text FROM documents
UNION ALL SELECT doc_id, 'absent', 'VOID', NULL FROM documents""",
    "csv_rejected": """SELECT c_custkey, CASE WHEN c_nationkey >= 10 THEN 'CSV_COLUMNS' END AS error_code,
  CASE WHEN c_nationkey >= 10 THEN 'CSV column count mismatch: expected 3 but got 2' END AS error_message FROM customer""",
    "dead_letter_rows": f"""SELECT original, code AS error_code, message AS error_message, 'unknown' AS topic,
  CAST(-1 AS INTEGER) AS partition, event_id AS offset FROM ({_LETTERS})""",
    "dead_letter_json": f"""SELECT '{{"errorClass":"' || code || '","errorMessage":"' || message || '","errorTimestampMs":0,"sourceTopic":"unknown",' ||
  '"sourcePartition":-1,"sourceOffset":' || event_id || ',"originalBytes":"' || base64(encode(original)) || '","originalText":' ||
  CAST(to_json(original) AS VARCHAR) || '}}' AS letter FROM ({_LETTERS})""",
    # the page counters come from JSON here and are plain whole numbers
    "chained_leaves": LINES
    + _counters("WHERE " + _WHOLE).replace("'INT'", "'BIGINT'")
    + "\nUNION ALL "
    + _items("lines", where=_WHOLE),
    "one_pass_leaves": LINES
    + _counters("WHERE bad IS NULL")
    + "\nUNION ALL "
    + _items("lines", where="(doc_id, p) IN (SELECT (doc_id, p) FROM pg WHERE bad IS NULL)"),
    "flow_results": LINES
    + """SELECT doc_id, p AS page_index, '{"count":' || count(*) || ',"index":' || p || ',"lines":[' ||
  string_agg('{"chars":' || length(t) || ',"lang":"' || upper(lang) || '","n":' || i || ',"text":' || CAST(to_json(t) AS VARCHAR) || '}', ',' ORDER BY i) ||
  '],"total":' || any_value(pages) || '}' AS json
FROM l GROUP BY doc_id, p HAVING count(*) FILTER (WHERE length(t) % 7 = 0) = 0""",
    "flow_rejects": LINES
    + """, msg AS (SELECT doc_id, CAST(length('{"document":{"id":' || doc_id || ',"lang":"' || any_value(lang) || '","source":"' || any_value(source) || '"},"lines":[' ||
  string_agg('{"n":' || i || ',"chars":' || length(t) || ',"lang":"' || lang || '"' ||
    CASE WHEN length(t) % 7 = 0 THEN '' ELSE ',"text":' || CAST(to_json(t) AS VARCHAR) END || '}', ',' ORDER BY i) || ']}') AS INTEGER) AS n_original
  FROM l GROUP BY doc_id)
SELECT doc_id, n_original, 'ITEM_REQUIRED' AS error_code, 'Item validation failed: [' || bad || ']' AS error_message
FROM pg JOIN msg USING (doc_id) WHERE bad IS NOT NULL""",
    "flow_flat_messages": f"""SELECT event_id, {_EVENT_JSON.replace('{kind}', 'upper(event_type)')} AS json
FROM events WHERE event_type NOT IN ('signup', 'error', 'view')""",
}
