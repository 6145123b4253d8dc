"""The same results as ANSI SQL over the same tables, for checking the queries."""

from __future__ import annotations


def _topic(
    source: str, key: str, order: str, partitions: int, topic: str, body: str, first: str = ""
) -> str:
    """CTEs ``log`` (topic, p, o, k, body and the source's columns) and ``bounds``.

    SQL of the key hash for ASCII keys: UTF-16LE puts a zero byte after each character.
    """
    return f"""
    WITH hashed AS (
      SELECT *, {topic} AS topic, {key} AS k, {body} AS body,
             md5(regexp_replace({key}, '(.)', '\\1' || chr(0), 'g')) AS m
      FROM {source}),
    words AS (
      SELECT *, CAST('0x' || substr(m, 7, 2) || substr(m, 5, 2) || substr(m, 3, 2) || substr(m, 1, 2)
                AS BIGINT) AS x
      FROM hashed),
    placed AS (
      SELECT *, CAST(abs(CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) % {partitions}
                AS INTEGER) AS p
      FROM words),
    log AS (
      SELECT *, row_number() OVER (PARTITION BY topic, p ORDER BY {first}{order}) - 1 AS o FROM placed),
    bounds AS (
      SELECT topic, p, min(o) AS earliest, max(o) + 1 AS latest FROM log GROUP BY topic, p)
    """


def _csv(*columns: str) -> str:
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


_EVENT_BODY = _csv("event_id", "user_id", "event_type", "value")
_ORDER_BODY = _csv(
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
)
_EVENTS = _topic("events", "CAST(user_id AS VARCHAR)", "event_id", 4, "'events'", _EVENT_BODY)
_EVENT_TYPES = _topic("events", "CAST(user_id AS VARCHAR)", "event_id", 2, "event_type", _EVENT_BODY)
_DOCUMENTS = _topic("documents", "CAST(doc_id AS VARCHAR)", "doc_id", 4, "'documents'", "text")
_ORDERS = _topic(
    "orders", "o_orderpriority", "o_orderkey", 8, "'orders'", _ORDER_BODY, "(o_orderstatus <> 'F'), "
)
_GROWN = _topic(
    "events", "CAST(user_id AS VARCHAR)", "event_id", 4, "'events'", _EVENT_BODY,
    "(event_type NOT IN ('click', 'view')), ",
)
_BY_TYPE = _topic("events", "event_type", "event_id", 3, "'by_type'", _EVENT_BODY)

_WIDE = _topic(
    "events", "CAST(event_id AS VARCHAR)", "event_id", 400, "'wide'", _EVENT_BODY, "(event_type <> 'click'), "
)
_TEXTS = _topic("documents", "lang", "doc_id", 64, "'texts'", "text")

_FIELDS = "event_id, user_id, event_type, value"
_PLACED = f'p AS "partition", o AS "offset", {_FIELDS}'
_TEXT_ROWS = 'SELECT topic, p AS "partition", o AS "offset", k AS key, body AS value FROM log'
_MAP = 'topic, p AS "partition"'
_LINE = """WITH lines AS (
  SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, 'user' || page_id AS usr,
         regexp_extract(url, '^https?://[^/?#]+(.*)$', 1) AS path, length(html) AS size FROM pages)"""
_LABELLED = "(SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

ORACLES: dict[str, str] = {
    "s1_bounded_scan": f"{_EVENTS} SELECT {_PLACED} FROM log",
    "s2_stream_scan": f"{_EVENTS} {_TEXT_ROWS}",
    "s3_partition_select": f"{_EVENTS} SELECT {_PLACED} FROM log WHERE p IN (0, 2, 9)",
    "s4_topic_sample": f"{_EVENTS} SELECT body AS message FROM log ORDER BY p, o LIMIT 100",
    "s5_topic_catalogue": """SELECT event_type AS topic, count(*) OVER () AS total
        FROM (SELECT DISTINCT event_type FROM events) t ORDER BY topic LIMIT 3""",
    "s5_topic_lookup": """SELECT DISTINCT event_type AS topic, CAST(1 AS BIGINT) AS total
        FROM events WHERE event_type = 'click'""",
    "f1_earliest_offsets": f'{_EVENTS} SELECT {_MAP}, earliest AS "offset" FROM bounds',
    "f2_latest_offsets": f'{_EVENTS} SELECT {_MAP}, latest AS "offset" FROM bounds',
    "f2_segment_index": f"""{_WIDE} SELECT {_MAP}, o // 1048576 AS segment, min(o) AS first_offset,
        max(o) AS last_offset, count(*) AS messages FROM log GROUP BY ALL""",
    "f3_start_policy": f"""{_EVENTS} SELECT {_MAP}, CAST(starts AS BIGINT) AS "offset", policy FROM bounds,
        (VALUES ('beginning', -2), ('latest', -1), ('default', -1), ('specific', 7)) v(policy, starts)""",
    "f4_start_override": f"""{_EVENTS}
        SELECT {_MAP}, CAST(CASE p WHEN 1 THEN 5 WHEN 2 THEN 7 ELSE -2 END AS BIGINT) AS "offset" FROM bounds""",
    "f5_sentinel_substitution": f"""{_EVENTS}
        SELECT {_MAP}, CASE p WHEN 1 THEN latest WHEN 2 THEN 7 ELSE earliest END AS "offset" FROM bounds""",
    "f6_batch_start": f"""{_EVENTS}
        SELECT {_MAP}, CASE p WHEN 0 THEN 3 WHEN 1 THEN 9 ELSE earliest END AS "offset" FROM bounds""",
    "f7_range_plan": f"""{_EVENTS},
        starts AS (SELECT *, CASE p WHEN 0 THEN 3 WHEN 1 THEN 9 ELSE earliest END AS s FROM bounds)
        SELECT {_MAP}, s AS start_offset, least(latest, s + 100) AS end_offset FROM starts""",
    "f8_range_read": f"""{_EVENTS}
        SELECT {_PLACED} FROM log JOIN (SELECT p AS bp, latest FROM bounds) b ON p = bp
        WHERE o >= floor(latest * 1 / 3) AND o < floor(latest * 2 / 3)""",
    "f8_many_ranges": f"""{_WIDE} SELECT log.topic, log.p AS "partition", o AS "offset", k AS key, body AS value
        FROM log JOIN bounds b ON log.p = b.p WHERE log.p = 0 OR o = latest - 1""",
    "f8_offset_audit": f"""{_EVENTS},
        kept AS (SELECT p, o FROM log WHERE o % 97 NOT BETWEEN 5 AND 8),
        missing AS (SELECT p, lag(o) OVER (PARTITION BY p ORDER BY o) + 1 AS a, o AS b FROM kept),
        again AS (SELECT p, o, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run FROM kept WHERE o % 101 IN (3, 4))
        SELECT 'events' AS topic, p AS "partition", 'missing' AS kind, a AS start_offset, b AS end_offset
        FROM missing WHERE a < b
        UNION ALL SELECT 'events', p, 'repeated', min(o), max(o) + 1 FROM again GROUP BY p, run""",
    "f9_resume": f"""{_EVENTS}
        SELECT {_MAP}, CASE p WHEN 0 THEN 10 WHEN 2 THEN 20 ELSE earliest END AS "offset" FROM bounds""",
    "f10_saved_offset_check": f"""{_EVENTS},
        saved AS (SELECT * FROM (VALUES (0, -5), (1, 3), (2, 1152921504606846976), (9, 1)) v(sp, s))
        SELECT 'events' AS topic, sp AS "partition", s AS "offset", earliest, latest,
               'Offset ' || s || ', saved for topic events, partition ' || sp || ', ' ||
               CASE WHEN earliest IS NULL THEN 'belongs to no known partition.'
               ELSE 'is outside its range ' || earliest || ' to ' || latest || '.' END AS message
        FROM saved LEFT JOIN bounds ON p = sp
        WHERE earliest IS NULL OR s < earliest OR s > latest""",
    "f11_state_load": f'{_EVENTS} SELECT {_MAP}, latest AS "offset" FROM bounds',
    "f12_state_save": f'{_EVENTS} SELECT {_MAP}, least(latest, 2000) AS "offset" FROM bounds',
    "f13_backlog_estimate": f"""{_EVENTS},
        ranges AS (SELECT *, CAST(floor(latest / 3) AS BIGINT) AS s FROM bounds)
        SELECT {_MAP}, s AS start_offset, latest AS end_offset, latest - s AS records,
               (latest - s) * 1024 AS estimated_bytes FROM ranges""",
    "p1_raw_payload": f"SELECT {_EVENT_BODY} AS body FROM events",
    "p2_csv_decode": f"SELECT {_FIELDS} FROM events",
    "p3_tsv_decode": f"SELECT {_FIELDS} FROM events",
    "p4_text_decode": f'{_DOCUMENTS} SELECT p AS "partition", o AS "offset", text AS message FROM log',
    "p5_clf_decode": f"""{_LINE} SELECT host, '-' AS ident, usr AS "user",
        '10/Oct/2000:13:55:36 +0000' AS "time", 'GET ' || path || ' HTTP/1.1' AS request,
        200 AS status, size AS bytes FROM lines""",
    "p6_syslog_decode": """SELECT CAST(event_id % 192 AS INTEGER) AS priority,
        strftime(ts, '%b %d %H:%M:%S') AS "time", 'host' || user_id AS host, event_type AS app,
        event_id AS pid, props AS message FROM events""",
    "p7_pattern_decode": f"""{_LINE} SELECT 'GET' AS method,
        nullif(regexp_extract(path, '^[^?]*'), '') AS path,
        nullif(regexp_extract(path, '\\?(.*)$', 1), '') AS query, 200 AS status FROM lines""",
    "p7_grok_decode": f"""{_LINE} SELECT host AS client, usr AS "user", 'GET' AS verb, path AS target,
        200 AS status, size AS bytes FROM lines""",
    "p8_key_column": "SELECT event_id, CAST(user_id AS VARCHAR) AS message_key FROM events",
    "p9_partition_column": f"{_EVENTS} SELECT event_id, p AS read_from FROM log",
    "p10_offset_column": f"{_EVENTS} SELECT event_id, o AS read_at FROM log",
    "p11_batch_time_column": "SELECT count(*) AS stamped_rows, true AS one_time_per_batch FROM events",
    "p12_schema_shaping": f"""{_EVENTS} SELECT k, event_id, p, CAST(user_id AS INTEGER) AS user_id,
        event_type, o, CAST(value AS DECIMAL(12, 2)) AS value FROM log""",
    "p13_null_normalisation": f"""SELECT CASE WHEN quality IS NULL THEN '' ELSE CAST(doc_id AS VARCHAR) END AS k,
        coalesce(CAST(quality AS VARCHAR), '') AS body FROM {_LABELLED} t""",
    "k1_publish_rows": f"{_ORDERS} {_TEXT_ROWS}",
    "k1_wide_topic": f"{_WIDE} {_TEXT_ROWS}",
    "k1_large_bodies": f'{_TEXTS} SELECT p AS "partition", o AS "offset", lang AS key, md5(text) AS digest FROM log',
    "k2_csv_body": f"SELECT {_ORDER_BODY} AS body FROM orders",
    "k3_json_body": """SELECT CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,
        'o_orderstatus', o_orderstatus, 'o_totalprice', o_totalprice,
        'o_orderdate', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000'),
        'o_orderpriority', o_orderpriority) AS VARCHAR) AS body FROM orders""",
    "k4_keyed_messages": f"SELECT o_orderpriority AS key, {_ORDER_BODY} AS body FROM orders",
    "k5_keyless_messages": f"""SELECT true AS keyless, CAST(o_orderkey % 8 AS INTEGER) AS "partition",
        {_ORDER_BODY} AS body FROM orders""",
    "k6_string_partitioner": f"""{_EVENTS},
        signed AS (SELECT *, abs(CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) AS h FROM log)
        SELECT event_id, CAST(h % 4 AS INTEGER) AS of_4, CAST(h % 7 AS INTEGER) AS of_7,
               CAST(h % 1000 AS INTEGER) AS of_1000 FROM signed""",
    "k7_alert_publish": f"""SELECT 'alerts' AS topic, true AS keyless,
        '{{"stageName":"nullAlert","payload":{{"doc_id":"' || doc_id || '","lang":"' || lang || '"}}}}' AS body
        FROM {_LABELLED} t WHERE quality IS NULL""",
    "k8_alert_routing": f"""SELECT 'labelled' AS topic, lang AS key, {_csv('doc_id', 'lang', 'quality', 'toxic')} AS body
        FROM {_LABELLED} t WHERE quality IS NOT NULL AND toxic IS NOT NULL
        UNION ALL
        SELECT 'alerts', NULL, '{{"stageName":"nullAlert","payload":{{}}}}'
        FROM {_LABELLED} t WHERE quality IS NULL OR toxic IS NULL""",
    "k9_stream_publish": f"{_BY_TYPE} {_TEXT_ROWS}",
    "t1_stream_decode": f"{_EVENTS} SELECT {_PLACED} FROM log",
    "t2_stream_restart": f"{_GROWN} SELECT {_PLACED} FROM log",
    "t3_state_commit": f'{_EVENTS} SELECT {_MAP}, latest AS "offset" FROM bounds',
    "t3_offset_islands": f"""{_EVENTS},
        runs AS (SELECT p, o, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run FROM log WHERE event_type = 'click')
        SELECT 'events' AS topic, p AS "partition", min(o) AS start_offset, max(o) + 1 AS end_offset FROM runs GROUP BY p, run""",
    "t3_interleaved_state": f'{_EVENTS} SELECT {_MAP}, latest AS "offset" FROM bounds',
    "t4_state_resume": f"""{_EVENTS} SELECT {_PLACED} FROM log JOIN (SELECT p AS bp, latest FROM bounds) b
        ON p = bp WHERE o >= floor(latest / 2)""",
    "t5_failure_replay": f"{_EVENTS} SELECT {_PLACED} FROM log",
    "t5_replay_anew": f"{_EVENTS} SELECT {_PLACED} FROM log",
    "t6_rate_plan": f"""{_EVENTS} SELECT {_MAP}, earliest AS start_offset,
        least(latest, earliest + 250) AS end_offset FROM bounds""",
}
