"""DuckDB SQL that gives each query's result from the plain tables, without bytes, decoding or replay."""

from __future__ import annotations

from tidelog.sources import partlog as P
from tidelog.sources.changelog import BASE_LSN, MOVED, OID, SPAN

_LOG = f"""
WITH o AS (SELECT *, o_orderkey // 100 AS b, o_orderkey % 4 AS m, o_orderkey % 100 AS k, (o_orderkey // 100) % 7 AS way FROM orders),
raw AS (
  SELECT *, 0 AS t, 'I' AS tag, false AS moved FROM o
  UNION ALL SELECT *, 1, 'U', false FROM o WHERE m = 2
  UNION ALL SELECT *, 1, 'U', true FROM o WHERE m = 1 AND way = 3
  UNION ALL SELECT *, 2, 'D', false FROM o WHERE m = 3),
log AS (
  SELECT *, b * {SPAN} + t * 300 + 10 + CASE WHEN way IN (5, 6) AND k >= 50 THEN k + 30 ELSE k + 1 END AS seq, 1000 + 3 * b + t AS xid,
         b * {SPAN} + t * 300 + 10 AS zero, way < 4 OR way = 5 OR (way = 4 AND b % 2 = 0) AS done,
         b * {SPAN} + t * 300 + 10 + CASE WHEN way = 4 THEN 160 ELSE 150 END AS end_seq
  FROM raw),
txns AS (SELECT DISTINCT b, way, t, 1000 + 3 * b + t AS xid, b * {SPAN} + t * 300 + 10 AS zero
         FROM o, (SELECT unnest([0, 1, 2]) AS t)),
control AS (
  SELECT zero AS seq, 'begin' AS event_type, xid, NULL::BIGINT AS commit_at, NULL::BIGINT AS end_at, NULL AS gid, false AS in_stream, b, t FROM txns WHERE way < 4
  UNION ALL SELECT zero + 150, 'commit', NULL, 150, 151, NULL, false, b, t FROM txns WHERE way < 4
  UNION ALL SELECT zero + p, 'stream_start', xid, NULL, NULL, NULL, true, b, NULL FROM txns, (SELECT unnest([0, 70]) AS p) WHERE way IN (5, 6)
  UNION ALL SELECT zero + p, 'stream_stop', NULL, NULL, NULL, NULL, false, b, NULL FROM txns, (SELECT unnest([60, 140]) AS p) WHERE way IN (5, 6)
  UNION ALL SELECT zero + 150, 'stream_commit', xid, 150, 151, NULL, false, b, t FROM txns WHERE way = 5
  UNION ALL SELECT zero + 150, 'stream_abort', xid, NULL, NULL, NULL, false, b, t FROM txns WHERE way = 6
  UNION ALL SELECT zero, 'begin_prepare', xid, NULL, 151, 'g' || xid, false, b, t FROM txns WHERE way = 4
  UNION ALL SELECT zero + 150, 'prepare', xid, NULL, 151, 'g' || xid, false, b, t FROM txns WHERE way = 4
  UNION ALL SELECT zero + 160, 'commit_prepared', xid, 160, 161, 'g' || xid, false, b, t FROM txns WHERE way = 4 AND b % 2 = 0
  UNION ALL SELECT zero + 160, 'rollback_prepared', xid, NULL, 161, 'g' || xid, false, b, t FROM txns WHERE way = 4 AND b % 2 = 1),
others AS (
  SELECT zero + x.p AS seq, x.e AS event_type, x.f AS flags, x.prefix, x.content, x.origin, x.type_name, x.n FROM txns, (VALUES
    (120, 'message', 1, 'note', 'batch one', NULL, NULL, NULL), (121, 'origin', NULL, NULL, NULL, 'elsewhere', NULL, NULL),
    (122, 'type', NULL, NULL, NULL, NULL, 'mood', NULL), (123, 'truncate', 1, NULL, NULL, NULL, NULL, 0::BIGINT)
  ) AS x(p, e, f, prefix, content, origin, type_name, n) WHERE b = 1 AND t = 0),
rels AS (SELECT zero - 1 AS seq, b FROM txns WHERE b IN (0, 5, 10) AND t = 0),
all_events AS (
  SELECT seq, CASE tag WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS event_type FROM log
  UNION ALL SELECT seq, event_type FROM control UNION ALL SELECT seq, event_type FROM others
  UNION ALL SELECT seq, 'relation' FROM rels WHERE b = 10),
state AS (
  SELECT CASE WHEN m = 1 AND way = 3 THEN o_orderkey + {MOVED} ELSE o_orderkey END AS o_orderkey, o_custkey,
         CASE WHEN m = 2 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, b
  FROM o WHERE m <> 3 AND (way < 4 OR way = 5 OR (way = 4 AND b % 2 = 0)))
"""
_AT = f"{BASE_LSN} + 64 * "

_PARTS = f"""
WITH p AS (SELECT *, p_partkey // {P.BATCH} AS b, p_partkey % {P.BATCH} AS k, (p_partkey // {P.BATCH}) % 6 AS way, {P.FIRST_XID} + (p_partkey // {P.BATCH}) % {P.XIDS} AS xid
           FROM part WHERE p_partkey IS NOT NULL),
whole AS (SELECT *, way IN (0, 1, 4) OR b % 12 = 3 AS done, way = 1 AND k % 5 = 4 AS cut, b * {P.BUCKET} AS zero FROM p),
raw AS (
  SELECT *, zero + 100 + k AS seq, 'I' AS tag, 'parts' AS tab FROM whole
  UNION ALL SELECT *, zero + 200 + k, 'U', 'parts' FROM whole WHERE k % 3 = 1
  UNION ALL SELECT *, zero + 300 + k, 'D', 'parts' FROM whole WHERE k % 3 = 2
  UNION ALL SELECT whole.*, zero + 400 + n + 2 * k, 'I', 'loose' FROM whole, (SELECT unnest([0, 1]) AS n) WHERE k % 10 = 0
  UNION ALL SELECT *, zero + 600 + k, 'I', 'bins' FROM whole WHERE k % 7 = 0),
batches AS (SELECT DISTINCT b, way, xid, zero, done FROM whole),
status AS (SELECT *, CASE WHEN done THEN 'committed' WHEN way = 2 THEN 'aborted' WHEN way = 3 THEN 'rolled_back' ELSE 'open' END AS status FROM batches)
"""
_LAST = P.LAST

ORACLES = {
    "lsn_format": f"SELECT event_id, printf('%X/%X', v >> 32, v & 4294967295) AS lsn_text FROM (SELECT event_id, {BASE_LSN} + event_id * 4294967296 + event_id AS v FROM events)",
    "lsn_parse": "SELECT event_id, event_id * 4294967296 + event_id * 7 AS lsn FROM events",
    "pg_timestamp": "SELECT event_id, epoch_us(ts) - 946684800000000 AS server_micros, true AS round_trip FROM events",
    "decode_insert": _LOG + "SELECT seq, 'public' AS schema, 'orders' AS table, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM log WHERE tag = 'I'",
    "decode_update": _LOG + f"""SELECT seq, 'default' AS replica_identity, 'o_orderkey' AS key_columns, CASE WHEN moved THEN o_orderkey END AS old_key,
        CASE WHEN moved THEN o_orderkey + {MOVED} ELSE o_orderkey END AS new_key, CASE WHEN moved THEN o_orderstatus ELSE 'U' END AS status, NOT moved AS customer_unchanged
        FROM log WHERE tag = 'U'""",
    "decode_delete": _LOG + "SELECT seq, 'K' AS key_type, o_orderkey, CASE WHEN b >= 10 THEN 5::BIGINT ELSE 4 END AS n_columns FROM log WHERE tag = 'D'",
    "decode_control": _LOG + f"""SELECT seq, event_type, xid, CASE WHEN commit_at IS NOT NULL THEN {_AT}(seq - seq % 10 + 0 * commit_at + (seq % 10)) END AS commit_lsn,
        CASE WHEN end_at IS NOT NULL THEN {_AT}(CASE WHEN event_type = 'begin_prepare' THEN seq + 151 ELSE seq + 1 END) END AS end_lsn, gid, in_stream,
        CASE WHEN t IS NOT NULL AND event_type <> 'stream_abort' OR event_type = 'stream_abort' THEN 946684800 + 757382400 + b * 60 + t END AS event_seconds
        FROM control""",
    "decode_other": _LOG + "SELECT seq, event_type, flags, prefix, content, origin AS origin_name, type_name, n AS n_tables FROM others",
    "relation_changes": _LOG + f"""SELECT {OID}::BIGINT AS oid, seq AS valid_from_seq, lead(seq) OVER (ORDER BY seq) AS valid_to_seq, b = 10 AS is_change,
        CASE WHEN b = 10 THEN 5::BIGINT ELSE 4 END AS n_columns, 'public.orders' AS full_name FROM rels WHERE b <> 5""",
    "key_columns": _LOG + "SELECT tag, 'o_orderkey' AS key_columns, 'default' AS replica_identity, count(*) AS n FROM log WHERE tag <> 'I' GROUP BY tag",
    "truncate_tables": _LOG + "SELECT seq, 1 AS flags, '' AS tables FROM others WHERE event_type = 'truncate' UNION ALL SELECT 1000000000, 1, 'public.orders'",
    "txn_assign": _LOG + "SELECT seq, xid FROM log",
    "txn_stats": _LOG + """SELECT CASE WHEN way < 4 OR way = 5 OR (way = 4 AND b % 2 = 0) THEN 'committed' WHEN way = 6 THEN 'aborted' ELSE 'rolled_back' END AS status,
        count(*) AS transactions, CAST(sum((SELECT count(*) FROM log WHERE log.xid = txns.xid) + CASE WHEN b = 1 AND t = 0 THEN 1 ELSE 0 END) AS BIGINT) AS changes
        FROM txns GROUP BY 1""",
    "committed_only": _LOG + "SELECT seq, tag, xid, end_seq AS commit_seq FROM log WHERE done",
    "aborted_rows": _LOG + "SELECT seq, tag, xid FROM log WHERE NOT done",
    "two_phase_visible": _LOG + "SELECT xid, 'g' || xid AS gid, CASE WHEN b % 2 = 0 THEN 'committed' ELSE 'rolled_back' END AS status, zero + 160 AS commit_seq FROM txns WHERE way = 4",
    "bounded_replay": _LOG + f"""SELECT count(*) AS n_events, max(seq) AS last_seq, count(*) FILTER (event_type = 'commit') AS n_commits FROM all_events
        WHERE seq <= (SELECT min(seq) FROM control WHERE commit_at IS NOT NULL AND seq + 1 >= {2 * SPAN})""",
    "bounded_replay_raw": _LOG + f"""SELECT count(*) AS n_frames, max(seq) AS last_seq FROM (
        SELECT seq FROM all_events UNION ALL SELECT seq FROM rels WHERE b <> 10)
        WHERE seq <= (SELECT min(seq) FROM (SELECT seq FROM all_events UNION ALL SELECT seq FROM rels) WHERE seq + 1 >= {2 * SPAN})""",
    "net_state": _LOG + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM state",
    "chunked_snapshot": _LOG + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM state",
    "upserted_state": _LOG + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM state",
    "net_state_whole_rows": _LOG + "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice FROM state",
    "history_scd2": _LOG + f"""SELECT o_orderkey, valid_from, CASE WHEN live THEN valid_to END AS valid_to, status FROM (
        SELECT key AS o_orderkey, end_seq AS valid_from, live, status, lead(end_seq) OVER (PARTITION BY key ORDER BY end_seq, seq, step) AS valid_to FROM (
          SELECT o_orderkey AS key, end_seq, seq, 1 AS step, true AS live, o_orderstatus AS status FROM log WHERE done AND tag = 'I'
          UNION ALL SELECT o_orderkey, end_seq, seq, 1, true, 'U' FROM log WHERE done AND tag = 'U' AND NOT moved
          UNION ALL SELECT o_orderkey, end_seq, seq, 0, false, NULL FROM log WHERE done AND (tag = 'D' OR moved)
          UNION ALL SELECT o_orderkey + {MOVED}, end_seq, seq, 1, true, o_orderstatus FROM log WHERE done AND moved)) WHERE live""",
    "toast_fill": _LOG + "SELECT seq, o_custkey FROM log WHERE done AND tag = 'U' AND NOT moved",
    "typed_strict": """SELECT event_id, CASE event_id % 6 WHEN 2 THEN -event_id WHEN 3 THEN 42 WHEN 4 THEN -7 WHEN 5 THEN 99999999999 ELSE event_id END AS number,
        event_id % 6 IN (0, 2, 3, 5) AS flag, event_type AS word, 7 AS extra FROM events""",
    "typed_lenient": """SELECT event_id, CAST(CASE WHEN k < 2 THEN event_id WHEN k = 2 THEN -event_id ELSE 0 END AS INT) AS number,
        k IN (0, 2, 5) AS flag, event_type AS word, CASE WHEN k < 3 THEN 0::BIGINT WHEN k = 5 THEN 1 ELSE 2 END AS n_errors,
        CASE k WHEN 3 THEN 'failed to parse '' 42'' as i32' WHEN 4 THEN 'failed to parse ''42.7'' as i32' WHEN 5 THEN 'failed to parse ''99999999999'' as i32' ELSE '' END AS first_error
        FROM (SELECT *, event_id % 6 AS k FROM events)""",
    "row_json": _LOG + """SELECT seq, '{"o_orderkey":"' || o_orderkey || '","o_custkey":null,"o_orderstatus":null,"o_totalprice":null' ||
        CASE WHEN b >= 10 THEN ',"o_orderpriority":null}' ELSE '}' END AS json FROM log WHERE tag = 'D'""",
    "route_counts": _LOG + "SELECT CASE event_type WHEN 'insert' THEN 'loads' WHEN 'delete' THEN 'drops' ELSE 'rest' END AS handler, count(*) AS n FROM all_events GROUP BY 1",
    "event_categories": _LOG + "SELECT event_type, count(*) AS n FROM all_events GROUP BY event_type",
    "progress_lsn": _LOG + f"""SELECT e.seq, {_AT}max(e.seq) OVER w AS received,
        coalesce(max(CASE WHEN c.commit_at IS NOT NULL THEN {_AT}(e.seq + 1) END) OVER w, 0) AS applied
        FROM all_events e LEFT JOIN control c ON e.seq = c.seq AND c.commit_at IS NOT NULL WINDOW w AS (ORDER BY e.seq ROWS UNBOUNDED PRECEDING)""",
    "positions_across_edge": _LOG + """, m AS (SELECT max(seq) // 2 AS middle FROM all_events),
        placed AS (SELECT e.seq, 9223372036854775808::HUGEINT + 64 * (e.seq - middle) AS p, c.seq IS NOT NULL AS done, c.seq + 1 - middle >= 200 AS past
                   FROM all_events e CROSS JOIN m LEFT JOIN control c ON e.seq = c.seq AND c.commit_at IS NOT NULL)
        SELECT seq, printf('%X/%X', CAST(p // 4294967296 AS BIGINT), CAST(p % 4294967296 AS BIGINT)) AS place, CAST(max(p) OVER w AS VARCHAR) AS received,
               coalesce(CAST(max(CASE WHEN done THEN p + 64 END) OVER w AS VARCHAR), '0') AS applied, seq <= coalesce(min(CASE WHEN past THEN seq END) OVER (), seq) AS kept
        FROM placed WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
    "metrics_latency": _LOG + """SELECT 'orders_slot' AS slot, count(*) AS n_gaps, quantile_cont(gap, 0.5) AS p50, quantile_cont(gap, 0.99) AS p99 FROM (
        SELECT server_time - lag(server_time) OVER (ORDER BY seq) AS gap FROM (
          SELECT seq, b * 60000000 + t * 1000000 AS server_time FROM log
          UNION ALL SELECT seq, b * 60000000 + coalesce(t, CAST((seq - 10) % 1000 // 300 AS INT)) * 1000000 FROM control
          UNION ALL SELECT seq, 60000000 FROM others UNION ALL SELECT seq, b * 60000000 FROM rels)) WHERE gap IS NOT NULL""",
    "snapshot_plus_stream": _LOG + """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey // 100 < (SELECT (max(o_orderkey) + 1) // 200 FROM orders)
        UNION ALL SELECT o_orderkey, o_orderstatus FROM state WHERE b >= (SELECT (max(o_orderkey) + 1) // 200 FROM orders)""",
    "encode_roundtrip": _LOG + "SELECT true AS same, (SELECT count(*) FROM all_events) + (SELECT count(*) FROM rels WHERE b <> 10) AS n",
    "frames_header": _LOG + f"""SELECT seq, {_AT}seq AS wal_start, {_AT}(seq + 1) AS wal_end, 757382400000000 + b * 60000000 + t * 1000000 AS server_time FROM (
        SELECT seq, b, t FROM log UNION ALL SELECT seq, b, coalesce(t, CAST((seq - 10) % 1000 // 300 AS INT)) FROM control
        UNION ALL SELECT seq, 1, 0 FROM others UNION ALL SELECT seq, b, 0 FROM rels)""",
    "full_identity_state": _PARTS + """SELECT p_partkey, p_name, p_brand, CAST(p_size + CASE WHEN k % 3 = 1 THEN 1 ELSE 0 END AS INT) AS p_size, p_retailprice
        FROM whole WHERE done AND NOT cut AND k % 3 <> 2""",
    "keyless_copies": _PARTS + "SELECT p_brand AS brand, count(*) AS n FROM raw WHERE tab = 'loose' AND done AND NOT cut GROUP BY 1",
    "binary_columns": _PARTS + "SELECT seq, p_partkey AS id, p_name AS body FROM raw WHERE tab = 'bins'",
    "full_old_rows": _PARTS + """SELECT seq, tag, 'O' AS key_type, 'full' AS replica_identity, 'p_partkey,p_name,p_brand,p_size,p_retailprice' AS key_columns, CAST(p_size AS BIGINT) AS old_size,
        CASE WHEN tag = 'U' THEN CAST(p_size + 1 AS BIGINT) END AS new_size FROM raw WHERE tag <> 'I'""",
    "reused_xids": _PARTS + f"""SELECT xid, zero + 10 AS begin_seq, status, zero + {_LAST} AS commit_seq, CASE WHEN way = 3 THEN 'p' || b END AS gid
        FROM status WHERE way <> 5""",
    "rolled_back_parts": _PARTS + f"SELECT seq, xid + {P.PART_XID} AS part_xid FROM raw WHERE cut",
    "bucket_edges": _PARTS + f"""SELECT zero + {_LAST} AS seq, 'C' AS tag, xid, zero + 10 AS begin_seq FROM batches WHERE way IN (0, 4)
        UNION ALL SELECT zero + {P.BUCKET}, 'M', NULL, NULL FROM batches WHERE way = 4""",
    "undecided_transactions": _PARTS + """SELECT status, count(*) AS transactions, CAST(sum((SELECT count(*) FROM raw WHERE raw.b = status.b)) AS BIGINT) AS changes
        FROM status GROUP BY status""",
    "typed_update": _LOG + f"""SELECT seq, CASE WHEN moved THEN o_orderkey END AS old_key, CASE WHEN moved THEN o_orderkey + {MOVED} ELSE o_orderkey END AS new_key,
        CASE WHEN moved THEN o_custkey END AS customer, CASE WHEN moved THEN o_orderstatus ELSE 'U' END AS status FROM log WHERE tag = 'U'""",
    "json_roundtrip": _PARTS + ", all_tables AS (SELECT tab AS t FROM raw WHERE tag = 'I' UNION ALL SELECT 'orders' FROM orders) SELECT t AS table, true AS same, count(*) AS n FROM all_tables GROUP BY t",
    "event_json": _LOG + f""", keyed AS (SELECT seq, CASE WHEN moved THEN o_orderkey + {MOVED} ELSE o_orderkey END AS o_orderkey FROM log),
        named AS (SELECT seq, event_type, list_aggregate(list_transform(string_split(event_type, '_'), lambda x: upper(x[1]) || x[2:]), 'string_agg', '') AS kind FROM all_events)
        SELECT e.seq, kind, {_AT}e.seq AS lsn, o_orderkey, c.xid,
          CASE WHEN kind IN ('Begin', 'Commit') THEN strftime(make_timestamp((946684800 + 757382400 + c.b * 60 + c.t) * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS committed
        FROM named e LEFT JOIN keyed USING (seq) LEFT JOIN control c ON e.seq = c.seq""",
    "local_changes": _LOG + "SELECT seq, tag, xid FROM log WHERE done AND (b + t) % 3 <> 1",
    "latency_sketches": _LOG + """SELECT 'orders_slot' AS slot, (946684800 + server_time // 1000000) // 3600 * 3600 AS hour, count(*) AS n_gaps, true AS p50_holds, true AS p99_holds FROM (
        SELECT server_time, lag(server_time) OVER (ORDER BY seq) AS before FROM (
          SELECT seq, 757382400000000 + b * 60000000 + t * 1000000 AS server_time FROM log
          UNION ALL SELECT seq, 757382400000000 + b * 60000000 + coalesce(t, CAST((seq - 10) % 1000 // 300 AS INT)) * 1000000 FROM control
          UNION ALL SELECT seq, 757382400000000 + 60000000 FROM others UNION ALL SELECT seq, 757382400000000 + b * 60000000 FROM rels)) WHERE before IS NOT NULL GROUP BY 1, 2""",
    "metrics_rates": _LOG + """SELECT 'orders_slot' AS slot, 757382400 + b * 60 + t AS second, count(*) AS n_frames FROM (
          SELECT b, t FROM log UNION ALL SELECT b, coalesce(t, CAST((seq - 10) % 1000 // 300 AS INT)) FROM control
          UNION ALL SELECT 1, 0 FROM others UNION ALL SELECT b, 0 FROM rels) GROUP BY 1, 2""",
    "metrics_bytes": _LOG + """, named AS (SELECT *, 44 + CASE WHEN b >= 10 THEN 15 ELSE 0 END AS names, CASE WHEN b >= 10 THEN strlen(o_orderpriority) ELSE 0 END AS last_size,
          strlen(CAST(o_custkey AS VARCHAR)) + strlen(o_orderstatus) AS two, strlen(CAST(o_totalprice AS VARCHAR)) AS price,
          strlen(CAST(o_orderkey AS VARCHAR)) AS key_size, strlen(CAST(o_orderkey + 10000000 AS VARCHAR)) AS moved_size FROM log),
        sizes AS (
          SELECT 'insert' AS event_type, names + key_size + two + price + last_size + 6 + 50 AS n FROM named WHERE tag = 'I'
          UNION ALL SELECT 'update', names - 9 + key_size + 1 + price + last_size + 6 + 80 FROM named WHERE tag = 'U' AND NOT moved
          UNION ALL SELECT 'update', 2 * names + key_size + moved_size + two + price + last_size + 6 + 80 FROM named WHERE tag = 'U' AND moved
          UNION ALL SELECT 'delete', names + key_size + 6 + 60 FROM named WHERE tag = 'D'
          UNION ALL SELECT event_type, CASE WHEN event_type IN ('begin', 'commit') THEN 30 WHEN event_type = 'relation' THEN 100 ELSE 20 END
            FROM all_events WHERE event_type NOT IN ('insert', 'update', 'delete'))
        SELECT event_type, count(*) AS n_events, CAST(sum(n) AS BIGINT) AS n_bytes FROM sizes GROUP BY event_type""",
    "frames_across_chunks": _LOG + f"""SELECT {_AT}seq AS wal_start, {_AT}(seq + 1) AS wal_end, 757382400000000 + b * 60000000 + t * 1000000 AS server_time FROM (
        SELECT seq, b, t FROM log UNION ALL SELECT seq, b, coalesce(t, CAST((seq - 10) % 1000 // 300 AS INT)) FROM control
        UNION ALL SELECT seq, 1, 0 FROM others UNION ALL SELECT seq, b, 0 FROM rels)""",
    "recovered_log": _LOG + "SELECT seq AS place, tag, xid, end_seq AS commit_place FROM log WHERE done",
    "log_gaps": _LOG + f""", sent AS (SELECT seq FROM all_events UNION ALL SELECT seq FROM rels WHERE b <> 10), top AS (SELECT max(seq) AS top FROM sent)
        SELECT 2 AS session, {_AT}(max(seq) FILTER (seq <= top * 3 // 10) + 1) AS gap_from, {_AT}min(seq) FILTER (seq > top * 5 // 10) AS gap_to FROM sent, top""",
    "safe_progress": _LOG + f""", ends AS (SELECT DISTINCT end_seq AS seq FROM log WHERE done UNION SELECT seq FROM control WHERE commit_at IS NOT NULL),
        steps AS (SELECT seq, CASE WHEN seq % 13 <> 5 OR seq < 9000 THEN seq * 7 % 1000 + seq // 4000 * 500 END AS step FROM ends),
        safe AS (SELECT seq, max(coalesce(step, 1000000000)) OVER (ORDER BY seq) AS step FROM steps)
        SELECT step, max({_AT}(seq + 1)) AS safe_lsn FROM safe WHERE step < 1000000000 GROUP BY step""",
    "applied_intervals": _LOG + """, ends AS (SELECT DISTINCT seq, seq % 13 = 5 AND seq >= 9000 AS open FROM control WHERE commit_at IS NOT NULL),
        runs AS (SELECT seq, open, sum(CASE WHEN open THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS g FROM ends)
        SELECT min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM runs WHERE NOT open GROUP BY g""",
    "quarantine": _LOG + "SELECT tag, count(*) AS n FROM log WHERE b < 5 GROUP BY tag",
}
