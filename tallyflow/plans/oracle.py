"""DuckDB SQL that computes each registered query independently.

Tables are the driver's parquet files registered as views. The call-log
adapter rule (see ``tallyflow.sources.adapters``) is spelled out directly on
``events`` columns here, so the oracle does not go through the JSON path the
Spark side runs. Window starts use ``time_bucket``, whose origin is a day
boundary, so buckets of whole seconds/minutes/hours align with Spark's
epoch-aligned windows.
"""

# Java's \s class; DuckDB's RE2 \s lacks \x0B, so the class is spelled out.
_WS = r"[ \t\n\x0B\f\r]"

_WC_SPACE = """
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

WORD_COUNT_SPACE = _WC_SPACE

WORD_COUNT_WS = rf"""
WITH t AS (
  SELECT CASE
           WHEN regexp_full_match(text, '{_WS}+') THEN []::VARCHAR[]
           ELSE regexp_split_to_array(regexp_replace(text, '{_WS}+$', ''), '{_WS}+')
         END AS words
  FROM documents
)
SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(words) AS word FROM t)
GROUP BY word
"""

TOPIC_RECORDS = f"""
SELECT word AS key, CAST(count AS VARCHAR) AS value FROM ({_WC_SPACE})
"""

TOP_WORDS = f"""
SELECT word, count, rank FROM (
  SELECT word, count, rank() OVER (ORDER BY count DESC) AS rank FROM ({_WC_SPACE}))
WHERE rank <= 20
"""

# request tokens of conversations: position in the single-space split
_REQ_TOKENS = """
SELECT conv_id, turn, pos, word FROM (
  SELECT conv_id, turn,
         unnest(generate_series(0, len(arr) - 1)) AS pos,
         unnest(arr) AS word
  FROM (SELECT conv_id, turn, string_split(text, ' ') AS arr FROM conversations))
WHERE word <> ''
"""

LOOKUP_DROP = f"""
SELECT r.conv_id, r.turn, r.pos, r.word, w.count
FROM ({_REQ_TOKENS}) r JOIN ({_WC_SPACE}) w ON r.word = w.word
"""

LOOKUP_ZERO = f"""
SELECT r.conv_id, r.turn, r.pos, r.word, coalesce(w.count, 0) AS count
FROM ({_REQ_TOKENS}) r LEFT JOIN ({_WC_SPACE}) w ON r.word = w.word
"""

LOOKUP_NULL = f"""
SELECT r.conv_id, r.turn, r.pos, r.word, CAST(w.count AS VARCHAR) AS count
FROM ({_REQ_TOKENS}) r LEFT JOIN ({_WC_SPACE}) w ON r.word = w.word
"""

LOOKUP_IDENTITY = f"""
SELECT conv_id, turn, pos, word, [word] AS result FROM ({_REQ_TOKENS})
"""

EXCLAIM_N = """
SELECT conv_id, turn, text || repeat('!', 10) AS result FROM conversations
"""

# the call-log adapter rule, computed directly
_CALLLOG = """
WITH calllog AS (
  SELECT CAST(event_id AS VARCHAR) AS msg_id,
         'p' || CAST(user_id % 5 AS VARCHAR) AS project_name,
         'com.x.' || event_type AS class_name,
         'm' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR) AS method_name,
         epoch_ms(date_trunc('millisecond', ts)) AS ts_ms,
         date_trunc('millisecond', ts) AS event_time,
         '1000' || CAST(user_id % 3 AS VARCHAR) AS return_code,
         CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS status_code
  FROM events)
"""

PARSE_CALL_LOG = _CALLLOG + """
SELECT msg_id, project_name, class_name, method_name, ts_ms, event_time FROM calllog
"""

PARSE_CALL_LOG_STRICT = PARSE_CALL_LOG

JSON_KEY_STRICT = _CALLLOG + """
SELECT msg_id, project_name AS projectName FROM calllog
"""

JSON_KEY_FILTER = """
SELECT event_id, props, json_extract_string(props, '$.k') AS k
FROM events WHERE json_exists(props, '$.k')
"""

JSON_REJECTS = """
SELECT page_id, html FROM pages
WHERE html IS NOT NULL
  AND CASE WHEN json_valid(html) THEN json_type(html) <> 'OBJECT'
             OR json_type(json_extract(html, '$.projectName')) NOT IN ('VARCHAR', 'NULL')
           ELSE true END
"""

SENTENCE_RECORDS = """
SELECT CAST(NULL AS VARCHAR) AS key, text AS value FROM documents
"""

STATUS_ROUTE = _CALLLOG + """
SELECT return_code, status_code, project_name, class_name, method_name, ts_ms,
       event_time, msg_id
FROM calllog WHERE TRY_CAST(status_code AS INTEGER) = 0
"""


def _bucket(length: str) -> str:
    return f"time_bucket(INTERVAL '{length}', event_time)"


def _counts_by_name(length: str) -> str:
    b = _bucket(length)
    return _CALLLOG + f"""
, b AS (SELECT {b} AS window_start, project_name, class_name, method_name FROM calllog)
SELECT window_start, window_start + INTERVAL '{length}' AS window_end, name, key, count(*) AS n
FROM (SELECT window_start, 'project_name' AS name, project_name AS key FROM b
      UNION ALL SELECT window_start, 'class_name', class_name FROM b
      UNION ALL SELECT window_start, 'method_name', method_name FROM b)
GROUP BY window_start, name, key
"""


def _hierarchical_body(length: str) -> str:
    b = _bucket(length)
    return f"""
, g AS (
  SELECT {b} AS window_start, project_name, class_name, method_name,
         count(*) AS total_count, min(event_time) AS first_t
  FROM calllog GROUP BY ALL)
, h AS (
  SELECT window_start, window_start + INTERVAL '{length}' AS window_end,
         project_name, class_name, method_name, total_count,
         min(first_t) OVER (PARTITION BY window_start) AS timestamp
  FROM g)
"""


def _hierarchical(length: str) -> str:
    return _CALLLOG + _hierarchical_body(length) + """
SELECT window_start, window_end, project_name, class_name, method_name, total_count, timestamp FROM h
"""


WINDOW_COUNT_BY_NAME = _counts_by_name("1 hour")
PACK_MAP = _counts_by_name("1 hour")
HIERARCHICAL_COUNT = _hierarchical("1 hour")
HIERARCHICAL_COUNT_10S = _hierarchical("10 seconds")
PACK_LIST = _hierarchical("1 hour")

INDEX_DOCUMENTS = _CALLLOG + _hierarchical_body("1 hour") + """
SELECT 'logcount-' || strftime(timestamp, '%Y.%m.%d') AS _index, 'info' AS _type, project_name,
       class_name, method_name, total_count, timestamp
FROM h
"""

WINDOW_COUNT_CLASS = _CALLLOG + """
SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start,
       time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end,
       class_name, count(*) AS n
FROM calllog GROUP BY ALL
"""

SLIDING_COUNT = _CALLLOG + """
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, class_name, count(*) AS n
FROM (SELECT class_name, b - to_minutes(15 * k) AS window_start
      FROM (SELECT class_name, time_bucket(INTERVAL '15 minutes', event_time) AS b,
                   unnest([0, 1, 2, 3]) AS k
            FROM calllog))
GROUP BY ALL
"""

SLIDING_COUNT_NEW = _CALLLOG + """
SELECT e - INTERVAL '1 hour' AS window_start, e AS window_end, class_name, count(*) AS n
FROM (SELECT class_name, time_bucket(INTERVAL '15 minutes', event_time) + INTERVAL '15 minutes' AS e
      FROM calllog)
GROUP BY ALL
"""

CONDITIONAL_COUNTS = _CALLLOG + """
, w AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
         count(*) FILTER (WHERE return_code = '10000') AS login_success,
         count(*) FILTER (WHERE return_code = '10002') AS register_success,
         min(event_time) AS timestamp
  FROM calllog GROUP BY 1)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, metric, n, timestamp
FROM (SELECT window_start, timestamp, 'login_success' AS metric, login_success AS n FROM w
      UNION ALL
      SELECT window_start, timestamp, 'register_success', register_success FROM w)
WHERE n <> 0
"""

WINDOW_TOTAL = _CALLLOG + """
SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
       time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end,
       count(*) AS n
FROM calllog GROUP BY 1, 2
"""

WINDOW_LAST_KEY = _CALLLOG + """
SELECT tb AS window_start, tb + INTERVAL '1 hour' AS window_end,
       arg_max(project_name, (ts_ms, msg_id)) AS project_name, count(*) AS n
FROM (SELECT *, time_bucket(INTERVAL '1 hour', event_time) AS tb FROM calllog)
GROUP BY tb
"""

ROLLING_TOP_N = _CALLLOG + """
SELECT window_start, window_end, class_name, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, class_name ASC) AS rank
  FROM (SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
               time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end,
               class_name, count(*) AS n
        FROM calllog GROUP BY ALL))
WHERE rank <= 2
"""

ROLLING_TOP_USERS = """
SELECT window_start, window_start + INTERVAL '24 hours' AS window_end, user_id, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, user_id ASC NULLS FIRST) AS rank
  FROM (SELECT time_bucket(INTERVAL '6 hours', ts) - to_hours(6 * k) AS window_start, user_id, count(*) AS n
        FROM events, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE ts IS NOT NULL GROUP BY ALL))
WHERE rank <= 10
"""

RANK_LATEST = _CALLLOG + """
, wc AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end,
         class_name, count(*) AS n
  FROM calllog GROUP BY ALL)
, lp AS (
  SELECT class_name, arg_max(n, window_end) AS n, max(window_end) AS updated_at
  FROM wc GROUP BY class_name)
SELECT class_name, n, updated_at, rank FROM (
  SELECT *, rank() OVER (ORDER BY n DESC) AS rank FROM lp)
WHERE rank <= 3
"""

_WINDOW_COUNT_PROJECT = """
, wcp AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
         time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
         project_name AS projectName, count(*) AS num
  FROM calllog GROUP BY ALL)
, lp AS (
  SELECT projectName, arg_max(num, window_end) AS count, max(window_end) AS updated_at
  FROM wcp GROUP BY projectName)
, pauses AS (
  SELECT e, e - lag(e) OVER (ORDER BY e) AS pause FROM (SELECT DISTINCT window_end AS e FROM wcp))
, live AS (
  SELECT * FROM lp WHERE updated_at >= (
    SELECT max(e) FROM pauses WHERE pause IS NULL OR pause > INTERVAL '300 seconds'))
, hs AS (SELECT projectName, CAST(count AS VARCHAR) AS count FROM live)
"""

WINDOW_COUNT_PROJECT = _CALLLOG + _WINDOW_COUNT_PROJECT + "SELECT * FROM wcp"
LATEST_PER_KEY = _CALLLOG + _WINDOW_COUNT_PROJECT + "SELECT * FROM lp"
LATEST_WITH_TTL = _CALLLOG + _WINDOW_COUNT_PROJECT + "SELECT * FROM live"
HASH_STORE_RECORDS = _CALLLOG + _WINDOW_COUNT_PROJECT + "SELECT * FROM hs"

PROJECT_LOOKUP_NULL = _CALLLOG + _WINDOW_COUNT_PROJECT + """
, req AS (
  SELECT CAST(request_id AS BIGINT) AS request_id, args FROM (VALUES
    (0, 'openstacklog test'), (1, 'test openstacklog test2'), (2, 'p1 zz p2')) t(request_id, args))
, tok AS (
  SELECT request_id, unnest(generate_series(0, len(arr) - 1)) AS pos, unnest(arr) AS arg
  FROM (SELECT request_id, string_split(args, ' ') AS arr FROM req))
SELECT tok.request_id, tok.pos, tok.arg AS projectName, hs.count
FROM tok LEFT JOIN hs ON tok.arg = hs.projectName
WHERE tok.arg <> ''
"""

_USER_STATE = """
WITH uw AS (
  SELECT date_trunc('second', ts) + INTERVAL '1 second' AS e, user_id, count(*) AS n
  FROM events GROUP BY ALL)
, lu AS (SELECT user_id, arg_max(n, e) AS n, max(e) AS updated_at FROM uw GROUP BY user_id)
, pauses AS (SELECT e, e - lag(e) OVER (ORDER BY e) AS pause FROM (SELECT DISTINCT e FROM uw))
"""

STATE_TTL_KEY = _USER_STATE + """
SELECT * FROM lu WHERE updated_at > (SELECT max(e) FROM uw) + INTERVAL '120 seconds' - INTERVAL '6 hours'
"""

STATE_TTL_TABLE = _USER_STATE + """
SELECT * FROM lu WHERE updated_at >= (
  SELECT max(e) FROM pauses WHERE pause IS NULL OR pause > INTERVAL '1200 seconds')
"""

# 10 min windows that start every 4 min, each with its rows
_SLIDING_10_4 = """
, b AS (SELECT min(time_bucket(INTERVAL '4 minutes', event_time)) - INTERVAL '20 minutes' AS lo,
               max(event_time) AS hi FROM calllog)
, s AS (SELECT unnest(generate_series(lo, hi, INTERVAL '4 minutes')) AS window_start FROM b)
, r AS (
  SELECT s.window_start, s.window_start + INTERVAL '10 minutes' AS window_end, c.*,
         c.event_time >= s.window_start + INTERVAL '6 minutes' AS is_new
  FROM calllog c JOIN s ON c.event_time >= s.window_start
                       AND c.event_time < s.window_start + INTERVAL '10 minutes')
, f AS (SELECT window_start, min(event_time) AS timestamp FROM r GROUP BY window_start)
"""

HIERARCHICAL_NEW = _CALLLOG + _SLIDING_10_4 + """
SELECT r.window_start, r.window_end, project_name, class_name, method_name, count(*) AS total_count, f.timestamp
FROM r JOIN f ON r.window_start = f.window_start WHERE is_new GROUP BY ALL
"""

CONDITIONAL_NEW = _CALLLOG + _SLIDING_10_4 + """
SELECT r.window_start, r.window_end,
       CASE return_code WHEN '10000' THEN 'login_success' ELSE 'register_success' END AS metric,
       count(*) AS n, f.timestamp
FROM r JOIN f ON r.window_start = f.window_start
WHERE is_new AND return_code IN ('10000', '10002') GROUP BY ALL
"""

GENERAL_STREAM = _CALLLOG + "SELECT project_name, class_name, method_name, ts_ms, event_time FROM calllog"

_SECONDS = """
, sec AS (SELECT *, date_trunc('second', event_time) AS window_start,
                 date_trunc('second', event_time) + INTERVAL '1 second' AS window_end FROM calllog)
, sp AS (SELECT window_start, window_end, project_name AS projectName, count(*) AS num FROM sec GROUP BY ALL)
, closed AS (SELECT * FROM sp WHERE window_end <= (SELECT max(event_time) FROM calllog) - INTERVAL '5 seconds')
"""

WINDOW_COUNT_PROJECT_1S = _CALLLOG + _SECONDS + "SELECT * FROM sp"
WINDOW_LAST_KEY_1S = _CALLLOG + _SECONDS + """
SELECT window_start, window_end, arg_max(project_name, (ts_ms, msg_id)) AS project_name, count(*) AS n
FROM sec GROUP BY window_start, window_end
"""
RANKING_STORE = TOP_WORDS

# the mixed-message rule, computed directly
_MIXED = """
WITH mixed AS (
  SELECT CASE WHEN event_id % 7 <> 1 THEN CAST(event_id AS VARCHAR) END AS msg_id,
         event_id % 7 AS fault, user_id % 5 AS project,
         CASE WHEN event_id % 7 <> 2 THEN 'com.x.' || event_type END AS class_name,
         'm' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR) AS method_name,
         CASE WHEN event_id % 7 = 0 THEN 0 ELSE epoch_ms(date_trunc('millisecond', ts)) END AS ts_ms,
         CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS code, user_id % 3 AS rc, event_type
  FROM events)
, others AS (SELECT props AS value FROM events UNION ALL SELECT html FROM pages
             UNION ALL SELECT text FROM conversations)
, objects AS (SELECT value, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS ok
              FROM others WHERE value IS NOT NULL)
, told AS (
  SELECT *, to_json(struct_pack(returnCode := '1000' || CAST(rc AS VARCHAR),
                                meta := '{"code":"' || code || '"}')) AS info,
         CASE WHEN fault = 3 THEN CAST(project AS VARCHAR) ELSE '"p' || project || '"' END AS project_json
  FROM mixed)
, written AS (
  SELECT *, '{' || CASE WHEN msg_id IS NULL THEN '' ELSE '"id":"' || msg_id || '",' END
         || CASE WHEN class_name IS NULL THEN '' ELSE '"clazz":"class ' || class_name || '",' END
         || '"method":"' || method_name || '","outputInfo":' || to_json(CAST(info AS VARCHAR))
         || CASE WHEN fault = 0 THEN '' WHEN fault = 4 THEN ',"date":"not a date"' ELSE ',"date":' || ts_ms END
         || ',"projectName":' || project_json || '}' AS value
  FROM told)
"""


def _mixed_parse(project: str) -> str:
    return _MIXED + f"""
SELECT msg_id, {project} AS project_name, class_name, method_name, ts_ms,
       make_timestamp(ts_ms * 1000) AS event_time FROM mixed WHERE fault <> 4
UNION ALL
SELECT NULL, NULL, NULL, NULL, 0, TIMESTAMP '1970-01-01 00:00:00' FROM objects WHERE ok
"""


MIXED_PARSE_STRICT = _mixed_parse("CASE WHEN fault <> 3 THEN 'p' || CAST(project AS VARCHAR) END")
MIXED_PARSE_COERCE = _mixed_parse("CASE WHEN fault = 3 THEN CAST(project AS VARCHAR) ELSE 'p' || CAST(project AS VARCHAR) END")
MIXED_REJECTS = _MIXED + """
SELECT value FROM written WHERE fault = 4 UNION ALL SELECT value FROM objects WHERE NOT ok
"""
MIXED_KEY_STRICT = _MIXED + "SELECT 'p' || CAST(project AS VARCHAR) AS projectName, value FROM written WHERE fault <> 3"
MIXED_KEY_COERCE = _MIXED + """
SELECT CASE WHEN fault = 3 THEN CAST(project AS VARCHAR) ELSE 'p' || CAST(project AS VARCHAR) END AS projectName, value
FROM written
"""
MIXED_IDENTITY = _MIXED + """
SELECT msg_id, 'p' || CAST(project AS VARCHAR) AS project_name, ['p' || CAST(project AS VARCHAR)] AS result
FROM mixed WHERE fault NOT IN (3, 4)
"""

STREAM_LOG_ROLLUP = _CALLLOG + _hierarchical_body("10 seconds") + """
SELECT 'logcount-' || strftime(timestamp, '%Y.%m.%d') AS _index, 'info' AS _type, project_name,
       class_name, method_name, total_count, timestamp
FROM h WHERE window_end <= (SELECT max(event_time) FROM calllog) - INTERVAL '5 seconds'
"""
STREAM_WINDOW_ROWS = _CALLLOG + _SECONDS + "SELECT * FROM closed"
STREAM_KEYED_STORE = _CALLLOG + _SECONDS + """
SELECT projectName, arg_max(num, window_end) AS count, max(window_end) AS updated_at FROM closed GROUP BY projectName
"""
OBSERVED_ROWS = "SELECT doc_id, text AS line FROM documents"
WRITE_TIME_STAMP = _CALLLOG + """
SELECT 'logcount-' || strftime(event_time, '%Y.%m.%d') AS _index, 'info' AS _type, ts_ms, true AS stamped FROM calllog
"""

# the feeds of several micro-batches, and which of their rows are late: those
# whose window had ended by the watermark of the micro-batch before
_FEED = """
, span AS (SELECT min(ts_ms) AS lo, max(ts_ms) AS hi FROM calllog)
, feed AS (
  SELECT c.*, time_bucket(INTERVAL '1 minute', event_time) AS window_start,
         least(5, (ts_ms - lo) * 6 // (hi - lo + 1) + CASE WHEN CAST(msg_id AS BIGINT) % 11 = 0 THEN 1 ELSE 0 END
                  + CASE WHEN CAST(msg_id AS BIGINT) % 17 = 0 THEN 2 ELSE 0 END) AS slice
  FROM calllog c, span)
, marks AS (
  SELECT slice, max(max(event_time)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
                - INTERVAL '5 seconds' AS mark
  FROM feed GROUP BY slice)
, judged AS (
  SELECT feed.*, window_start + INTERVAL '1 minute' AS window_end,
         coalesce(window_start + INTERVAL '1 minute' <= mark, false) AS late
  FROM feed JOIN marks ON feed.slice = marks.slice)
"""
STREAM_KEPT_WINDOWS = _CALLLOG + _FEED + """
SELECT window_start, window_end, project_name, count(*) AS n FROM judged
WHERE NOT late AND window_end <= (SELECT max(event_time) FROM calllog) - INTERVAL '5 seconds' GROUP BY ALL
"""
STREAM_LATE_ROWS = _CALLLOG + _FEED + """
SELECT CAST(slice AS BIGINT) AS batch_id, msg_id, project_name, event_time FROM judged WHERE late
"""

_WORD_SLICES = """
WITH span AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM documents)
, slices AS (SELECT CAST((doc_id - lo) * 4 // (hi - lo + 1) AS BIGINT) AS batch_id, text FROM documents, span)
"""
STREAM_STATE_CHANGES = _WORD_SLICES + """
, c AS (SELECT batch_id, word, count(*) AS n
        FROM (SELECT batch_id, unnest(string_split(text, ' ')) AS word FROM slices) WHERE word <> '' GROUP BY ALL)
, t AS (SELECT batch_id, word, n, CAST(sum(n) OVER (PARTITION BY word ORDER BY batch_id) AS BIGINT) AS after FROM c)
SELECT batch_id, word, nullif(after - n, 0) AS before, after FROM t
"""
STREAM_RATE_LIMIT = _WORD_SLICES + """
SELECT batch_id, count(*) AS rows_in, count(*) AS observed FROM slices GROUP BY batch_id
"""
STREAM_MERGE_STORE = STREAM_KEYED_STORE
STORE_LOOKUP_WORDS = LOOKUP_ZERO
STORE_LOOKUP_PROJECTS = _CALLLOG + _SECONDS + """
, last AS (SELECT projectName, arg_max(num, window_end) AS count FROM closed GROUP BY projectName)
, req AS (
  SELECT CAST(request_id AS BIGINT) AS request_id, args FROM (VALUES
    (0, 'openstacklog test'), (1, 'test openstacklog test2'), (2, 'p1 zz p2')) t(request_id, args))
, tok AS (
  SELECT request_id, unnest(generate_series(0, len(arr) - 1)) AS pos, unnest(arr) AS arg
  FROM (SELECT request_id, string_split(args, ' ') AS arr FROM req))
SELECT tok.request_id, tok.pos, tok.arg AS projectName, CAST(last.count AS VARCHAR) AS count
FROM tok LEFT JOIN last ON tok.arg = last.projectName WHERE tok.arg <> ''
"""

SLIDING_CHANGES = _CALLLOG + """
, r AS (SELECT class_name, time_bucket(INTERVAL '15 minutes', event_time) + to_minutes(15 * k) AS e, k
        FROM calllog, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
SELECT e - INTERVAL '1 hour' AS window_start, e AS window_end, class_name, count(*) FILTER (k <= 4) AS n_all,
       count(*) FILTER (k = 1) AS n_new, count(*) FILTER (k = 5) AS n_expired
FROM r GROUP BY ALL
"""
SLIDING_BY_NAME = _CALLLOG + _SLIDING_10_4 + """
SELECT window_start, window_end, name, key, count(*) AS n
FROM (SELECT window_start, window_end, 'project_name' AS name, project_name AS key FROM r
      UNION ALL SELECT window_start, window_end, 'class_name', class_name FROM r
      UNION ALL SELECT window_start, window_end, 'method_name', method_name FROM r)
GROUP BY ALL
"""
AS_OF_LOOKUP = _CALLLOG + """
, m AS (SELECT project_name, time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS e, count(*) AS n
        FROM calllog GROUP BY ALL)
SELECT q.msg_id, q.project_name, q.event_time, m.n, m.e AS updated_at
FROM (SELECT * FROM calllog WHERE class_name = 'com.x.error') q
ASOF LEFT JOIN m ON q.project_name = m.project_name AND q.event_time >= m.e
"""

_DOCUMENTS = f"""
SELECT *, 'info' AS _type, 'logcount-' || strftime(event_time, '%Y.%m.%d') AS _index,
       CASE WHEN msg_id IS NULL THEN 'no id' WHEN class_name IS NULL THEN 'no class' END AS reason
FROM ({MIXED_PARSE_STRICT})
"""
INDEX_WRITTEN = f"""
SELECT msg_id, project_name, class_name, method_name, ts_ms, _type, _index FROM ({_DOCUMENTS}) WHERE reason IS NULL
"""
INDEX_REFUSED = f"""
SELECT msg_id, project_name, class_name, _index, reason, CAST(0 AS BIGINT) AS batch_id
FROM ({_DOCUMENTS}) WHERE reason IS NOT NULL
"""

RANKING_UPDATES = TOP_WORDS
RANKING_OF_REQUESTS = f"""
SELECT word, count, rank FROM (SELECT word, count, rank() OVER (ORDER BY count DESC) AS rank FROM ({_WC_SPACE}))
WHERE word IN (SELECT word FROM ({_REQ_TOKENS}))
"""
