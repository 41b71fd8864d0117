"""Oracle SQL per registered query (DuckDB dialect)."""
from __future__ import annotations

from oracle.base import (
    UUID_PREFIX,
    ROW_TYPES,
    gtid_txn,
    gtid_txn_text,
    gtid_uuid,
    op_class,
    padded_seq,
    parse_long,
    pipeline,
    raw_ctes,
    raw_name,
    seq_ctes,
    rowev_ctes,
    table_key,
    utc_ms,
    utc_s,
    with_,
)

CHANGE_COLS = (
    "binarylog, position, gtid_position, gtid, gtid_uuid, gtid_txn, server_id, timestamp, event, "
    '"table", query, query_fingerprint, query_hash, data, old, changed, columns'
)
FILE = "server_id, binarylog"
STATE_AT_MS = 867_628_800_000
RETAINED_FROM_MS = 852_076_800_000
SILENT_FROM_MS, SILENT_TO_MS = 883_612_800_000, 915_148_800_000
SNAP_UUID, SNAP_LO, SNAP_HI = UUID_PREFIX + "4", 1, 1000
HOUR, DAY = 3_600_000, 86_400_000


def flat(log):
    return with_(pipeline(log), f"SELECT {CHANGE_COLS}, {utc_ms('timestamp')} AS timestamp_utc, row_idx FROM changes")


def nofp(log, **kw):
    return pipeline(log, fingerprints=False, **kw)


def seq_only(log, query_scope="file"):
    return raw_ctes(log) + seq_ctes(raw_name(log), "s", query_scope)


def merged_ctes(src: str, out: str = "merged") -> list[tuple[str, str]]:
    """Plain gaps-and-islands merge of GTID events per file."""
    w = "PARTITION BY server_id, binarylog, uuid ORDER BY txn"
    return [
        (f"{out}_g", f"""
SELECT server_id, binarylog, {gtid_uuid('gtid')} AS uuid, {gtid_txn('gtid')} AS txn
FROM {src} WHERE event_type = 'GTID'"""),
        (f"{out}_b", f"""
SELECT *, CASE WHEN txn = lag(txn) OVER ({w}) + 1 THEN 0 ELSE 1 END AS brk FROM {out}_g WHERE txn IS NOT NULL"""),
        (f"{out}_i", f"""
SELECT *, sum(brk) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM {out}_b"""),
        (f"{out}_r", f"""
SELECT server_id, binarylog, uuid, isl, min(txn) AS lo, max(txn) AS hi FROM {out}_i GROUP BY server_id, binarylog, uuid, isl"""),
        (f"{out}_t", f"""
SELECT server_id, binarylog, uuid || ':' || string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR)
  ELSE CAST(lo AS VARCHAR) || '-' || CAST(hi AS VARCHAR) END, ':' ORDER BY lo, hi) AS s
FROM {out}_r GROUP BY server_id, binarylog, uuid"""),
        (out, f"""
SELECT server_id, binarylog, string_agg(s, ',' ORDER BY s) AS merged_gtids FROM {out}_t GROUP BY server_id, binarylog"""),
    ]


# ---- conversion -------------------------------------------------------------
def row_changes():
    return flat("orders")


def customer_changes():
    return flat("customer")


def control_changes():
    return flat("control")


def row_diff():
    return with_(nofp("orders"), f"""
SELECT {FILE}, position, row_idx, old, data, changed, columns FROM changes WHERE event = 'EXT_UPDATE_ROWS'""")


def change_counter():
    pk = ("concat_ws(':', coalesce(gtid_uuid, 'null'), coalesce(CAST(gtid_txn AS VARCHAR), 'null'), "
          "CAST(server_id AS VARCHAR), binarylog, CAST(position AS VARCHAR), CAST(counter AS VARCHAR))")
    return with_(nofp("orders"), f"SELECT {FILE}, position, row_idx, counter, {pk} AS pk FROM changes")


def multi_row_explode():
    """Straight from `lineitem`: an order is one event, the 4th of its five."""
    order = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")
    data = ("'{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || ',\"l_partkey\":' || l_partkey "
            "|| ',\"l_suppkey\":' || l_suppkey || ',\"l_quantity\":' || CAST(l_quantity AS BIGINT) "
            "|| ',\"price_cents\":' || CAST(round(l_extendedprice * 100) AS BIGINT) "
            "|| ',\"l_returnflag\":\"' || l_returnflag || '\",\"l_linestatus\":\"' || l_linestatus || '\"}'")
    return f"""
SELECT CAST(5 AS BIGINT) AS server_id, 'line-bin.' || printf('%06d', file + 1) AS binarylog,
  CAST(4 + 100 * ((l_orderkey - file * 2000) * 5 + 3) AS BIGINT) AS position, CAST(rn - 1 AS INTEGER) AS row_idx,
  '{UUID_PREFIX}5:' || l_orderkey AS gtid,
  CAST(row_number() OVER (PARTITION BY file ORDER BY l_orderkey, rn) AS BIGINT) AS counter, data,
  '["l_orderkey","l_linenumber","l_partkey","l_suppkey","l_quantity","price_cents","l_returnflag","l_linestatus"]' AS columns
FROM (SELECT l_orderkey, l_orderkey // 2000 AS file, {data} AS data,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn FROM lineitem) x"""


def statements():
    return with_(pipeline("lineitem"), f"""
SELECT {FILE}, position, CAST(count(*) AS BIGINT) AS n_rows, any_value(query) AS query,
  array_to_string(list_sort(list_distinct(list("table"))), ',') AS tables, min(event) AS event
FROM changes GROUP BY {FILE}, position""")


# ---- sequencing ---------------------------------------------------------------
def event_positions():
    return with_(seq_only("control"), f"SELECT {FILE}, seq, event_type, position FROM s")


def txn_tagging():
    return with_(seq_only("control"), f"SELECT {FILE}, seq, event_type, txn_gtid AS gtid, txn_position AS gtid_position FROM s")


def txn_segments():
    return with_(seq_only("control"), f"SELECT {FILE}, seq, CAST(segment AS BIGINT) AS segment FROM s")


def stale_query_carry():
    return with_(seq_only("control"), f"SELECT {FILE}, seq, last_query AS query FROM s WHERE event_type IN {ROW_TYPES}")


def query_txn_scope():
    return with_(seq_only("control", "txn"), f"SELECT {FILE}, seq, last_query AS query FROM s WHERE event_type IN {ROW_TYPES}")


def table_map_resolution():
    ctes = seq_only("control") + rowev_ctes("s", "r")
    return with_(ctes, f"""
SELECT {FILE}, seq, CAST(segment AS BIGINT) AS segment, table_id, db || '.' || tbl AS "table",
  to_json(column_names)::VARCHAR AS column_names FROM r""")


def captured_transactions():
    return with_(seq_only("control"), f"""
SELECT {FILE}, CAST(segment AS BIGINT) AS segment,
  arg_max({{'v': gtid}}, seq) FILTER (WHERE event_type = 'GTID').v AS gtid,
  CAST(arg_max({{'v': position}}, seq) FILTER (WHERE event_type = 'GTID').v AS VARCHAR) AS gtid_position,
  count(*) FILTER (WHERE event_type = 'XID') > 0 AS committed,
  CASE WHEN count(*) FILTER (WHERE event_type = 'XID') > 0
    THEN CAST(count(*) FILTER (WHERE event_type IN {ROW_TYPES}) AS BIGINT) END AS captured_events
FROM s WHERE segment >= 1 GROUP BY {FILE}, segment""")


# ---- statistics -----------------------------------------------------------------
def file_summary():
    ctes = raw_ctes("control") + merged_ctes("ctl_raw")
    ctes.append(("fs", f"""
SELECT {FILE},
  arg_max({{'v': server_id}}, seq) FILTER (WHERE event_type = 'PREVIOUS_GTIDS').v AS pg_server,
  arg_max({{'v': previous_gtids}}, seq) FILTER (WHERE event_type = 'PREVIOUS_GTIDS').v AS previous_gtids,
  arg_max({{'v': next_binlog}}, seq) FILTER (WHERE event_type = 'ROTATE').v AS next_binlog,
  arg_max({{'v': timestamp}}, seq) FILTER (WHERE event_type = 'ROTATE').v AS latest,
  arg_max({{'v': timestamp}}, seq) FILTER (WHERE event_type = 'FORMAT_DESCRIPTION').v AS earliest
FROM ctl_raw GROUP BY {FILE}"""))
    return with_(ctes, f"""
SELECT f.server_id, f.binarylog, CAST(coalesce(pg_server, 0) AS BIGINT) AS file_server_id, previous_gtids,
  coalesce(m.merged_gtids, '') AS merged_gtids, next_binlog, earliest, latest,
  {utc_ms('earliest')} AS earliest_utc, {utc_ms('latest')} AS latest_utc
FROM fs f LEFT JOIN merged m ON f.server_id = m.server_id AND f.binarylog = m.binarylog""")


def merge_gtids():
    return with_(raw_ctes("orders") + merged_ctes("ord_raw"), "SELECT * FROM merged")


def gtid_intervals():
    ctes = raw_ctes("orders") + merged_ctes("ord_raw")
    ctes.append(("parts", f"SELECT {FILE}, unnest(string_split(merged_gtids, ',')) AS p FROM merged"))
    ctes.append(("rng", f"""
SELECT {FILE}, split_part(p, ':', 1) AS uuid, unnest(string_split(p, ':')[2:]) AS r FROM parts WHERE p <> ''"""))
    return with_(ctes, f"""
SELECT {FILE}, uuid, {parse_long("split_part(r, '-', 1)")} AS lo,
  coalesce({parse_long("nullif(split_part(r, '-', 2), '')")}, {parse_long("split_part(r, '-', 1)")}) AS hi
FROM rng""")


def _etc():
    ctes = nofp("shop")
    ctes.append(("etc", """
SELECT coalesce(e.event_type, r.event_type) AS event_type, CAST(coalesce(events, 0) AS BIGINT) AS events,
  CAST(coalesce(rows, 0) AS BIGINT) AS rows, CAST(coalesce(events, 0) + coalesce(rows, 0) AS BIGINT) AS reference_count
FROM (SELECT event_type, count(*) AS events FROM shop_raw GROUP BY event_type) e
FULL OUTER JOIN (SELECT event AS event_type, count(*) AS rows FROM changes WHERE event IS NOT NULL GROUP BY event) r
  ON e.event_type = r.event_type"""))
    return ctes


def event_type_counts():
    return with_(_etc(), "SELECT * FROM etc")


def total_events():
    return with_(_etc(), """
SELECT CAST(sum(events) AS BIGINT) AS events, CAST(sum(rows) AS BIGINT) AS rows,
  CAST(sum(reference_count) AS BIGINT) AS total_events FROM etc""")


def _op_counts(src="changes"):
    return f"""
SELECT table_key, CAST(count(*) FILTER (WHERE op = 'write') AS BIGINT) AS writes,
  CAST(count(*) FILTER (WHERE op = 'update') AS BIGINT) AS updates,
  CAST(count(*) FILTER (WHERE op = 'delete') AS BIGINT) AS deletes,
  CAST(count(*) AS BIGINT) AS total
FROM (SELECT {table_key('"table"')} AS table_key, {op_class('event')} AS op FROM {src}
      WHERE event IS NOT NULL AND "table" IS NOT NULL) x
WHERE op IS NOT NULL GROUP BY table_key"""


def table_op_counts():
    return with_(nofp("shop"), _op_counts())


def table_event_counts():
    return with_(nofp("shop"), 'SELECT "table", event, CAST(count(*) AS BIGINT) AS n FROM changes GROUP BY "table", event')


def txn_rollup():
    return with_(nofp("shop"), f"""
SELECT {FILE}, gtid_position, any_value(gtid) AS gtid, CAST(count(*) AS BIGINT) AS n_rows,
  min(timestamp) AS first_ts, max(timestamp) AS last_ts,
  array_to_string(list_sort(list_distinct(list("table"))), ',') AS tables
FROM changes WHERE gtid_position IS NOT NULL GROUP BY {FILE}, gtid_position""")


# ---- fingerprints ---------------------------------------------------------------
def query_fingerprint():
    return with_(pipeline("shop"), """
SELECT query_fingerprint, query_hash, CAST(count(*) AS BIGINT) AS n_rows FROM changes GROUP BY query_fingerprint, query_hash""")


def new_query_shapes():
    return with_(pipeline("shop"), """
SELECT query_hash, min(timestamp) AS first_seen, CAST(count(*) AS BIGINT) AS rows_affected
FROM changes WHERE query_hash IS NOT NULL GROUP BY query_hash ORDER BY first_seen DESC, query_hash LIMIT 20""")


def shape_volume():
    return with_(pipeline("shop"), f"""
SELECT query_hash, query_fingerprint, "table", CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE {op_class('event')} = 'write') AS BIGINT) AS writes,
  CAST(count(*) FILTER (WHERE {op_class('event')} = 'update') AS BIGINT) AS updates,
  CAST(count(*) FILTER (WHERE {op_class('event')} = 'delete') AS BIGINT) AS deletes,
  round(count(*) / sum(count(*)) OVER (PARTITION BY "table"), 6) AS write_share
FROM changes WHERE query_hash IS NOT NULL GROUP BY query_hash, query_fingerprint, "table\"""")


def statement_stats_join():
    return with_(pipeline("shop"), """
SELECT h.query_hash, h.query_fingerprint, h.n_rows, s.n_statements, s.max_rows
FROM (SELECT query_hash, query_fingerprint, CAST(count(*) AS BIGINT) AS n_rows
      FROM changes WHERE query_hash IS NOT NULL GROUP BY query_hash, query_fingerprint) h
LEFT JOIN (SELECT query_hash, CAST(count(*) AS BIGINT) AS n_statements, CAST(max(n) AS BIGINT) AS max_rows
           FROM (SELECT server_id, binarylog, position, query_hash, count(*) AS n
                 FROM changes WHERE query_hash IS NOT NULL GROUP BY server_id, binarylog, position, query_hash) p
           GROUP BY query_hash) s
ON h.query_hash = s.query_hash""")


# ---- time travel -------------------------------------------------------------------
def _key(img, k="o_orderkey"):
    return f"TRY_CAST(json_extract_string({img}, '$.{k}') AS BIGINT)"


def _ord(sub="1"):
    return (f"{{'s': server_id, 'p': {padded_seq('binarylog')}, 'b': binarylog, 'pos': position, "
            f"'r': row_idx, 'sub': {sub}}}")


def keyed_ctes(src: str, k: str, out: str = "kd") -> list[tuple[str, str]]:
    moved = f"(event = 'EXT_UPDATE_ROWS' AND {_key('old', k)} IS DISTINCT FROM {_key('data', k)})"
    return [(out, f"""
SELECT {_key('data', k)} AS {k}, {op_class('event')} AS op, {_ord()} AS ord, data, old, timestamp FROM {src} WHERE NOT {moved}
UNION ALL
SELECT {_key('old', k)}, 'delete', {_ord('0')}, data, old, timestamp FROM {src} WHERE {moved}
UNION ALL
SELECT {_key('data', k)}, 'write', {_ord()}, data, old, timestamp FROM {src} WHERE {moved}""")]


def _state(kd: str, k: str, ts: int, preimage: bool) -> str:
    pre = (" WHEN lb IS NULL AND fa.op IN ('update', 'delete') THEN fa.old" if preimage else "")
    return f"""
SELECT {k}, data FROM (
  SELECT {k}, CASE WHEN lb IS NOT NULL THEN CASE WHEN lb.op <> 'delete' THEN lb.data END{pre} END AS data FROM (
    SELECT {k}, arg_max({{'op': op, 'data': data}}, ord) FILTER (WHERE timestamp <= {ts}) AS lb,
      arg_min({{'op': op, 'old': old}}, ord) FILTER (WHERE timestamp > {ts}) AS fa
    FROM {kd} GROUP BY {k}) g) h
WHERE data IS NOT NULL"""


def state_at():
    return with_(nofp("orders") + keyed_ctes("changes", "o_orderkey"), _state("kd", "o_orderkey", STATE_AT_MS, False))


def state_at_preimage():
    ctes = nofp("orders") + [("kept", f"SELECT * FROM changes WHERE timestamp >= {RETAINED_FROM_MS}")]
    return with_(ctes + keyed_ctes("kept", "o_orderkey"), _state("kd", "o_orderkey", STATE_AT_MS, True))


def row_history():
    w = f"PARTITION BY o_orderkey ORDER BY server_id, {padded_seq('binarylog')}, binarylog, position, row_idx"
    return with_(nofp("orders"), f"""
SELECT o_orderkey, CAST(row_number() OVER ({w}) AS INTEGER) AS version, event, binarylog, position, data,
  lag(data) OVER ({w}) AS prev_data
FROM (SELECT *, {_key('data')} AS o_orderkey FROM changes) c""")


def first_set():
    return with_(nofp("orders"), f"""
SELECT o_orderkey, f.gtid AS gtid, f.timestamp AS timestamp, f.binarylog AS binarylog, f.position AS position, f.query AS query FROM (
  SELECT {_key('data')} AS o_orderkey,
    arg_min({{'gtid': gtid, 'timestamp': timestamp, 'binarylog': binarylog, 'position': position, 'query': query}}, {_ord()}) AS f
  FROM changes
  WHERE (event = 'EXT_WRITE_ROWS' AND json_extract_string(data, '$.o_orderstatus') = 'F')
     OR (event = 'EXT_UPDATE_ROWS' AND json_extract_string(changed, '$.o_orderstatus.new') = 'F')
  GROUP BY 1) x""")


def transitions():
    return with_(nofp("orders"), f"""
SELECT {FILE}, position, gtid, {_key('data')} AS o_orderkey FROM changes
WHERE event = 'EXT_UPDATE_ROWS' AND json_extract_string(changed, '$.o_orderstatus.old') = 'O'
  AND json_extract_string(changed, '$.o_orderstatus.new') = 'F'""")


def _in_snap(neg: bool) -> str:
    cond = f"(gtid_uuid = '{SNAP_UUID}' AND gtid_txn BETWEEN {SNAP_LO} AND {SNAP_HI})"
    return f"NOT coalesce({cond}, false)" if neg else f"coalesce({cond}, false)"


def after_gtid_set():
    return with_(nofp("customer"), f"SELECT {FILE}, position, gtid, event FROM changes WHERE {_in_snap(True)}")


def bootstrap():
    k = "c_custkey"
    ctes = nofp("customer") + [
        ("inside", f"SELECT * FROM changes WHERE {_in_snap(False)}"),
        ("later", f"SELECT * FROM changes WHERE {_in_snap(True)}"),
    ]
    ctes += keyed_ctes("inside", k, "kin") + keyed_ctes("later", k, "klt")
    ctes.append(("snap", _state("kin", k, 1 << 62, False)))
    ctes.append(("allk", f"""
SELECT {k}, 'write' AS op, 0 AS lvl, NULL::STRUCT(s BIGINT, p VARCHAR, b VARCHAR, pos BIGINT, r INTEGER, sub INTEGER) AS ord, data FROM snap
UNION ALL SELECT {k}, op, 1, ord, data FROM klt"""))
    return with_(ctes, f"""
SELECT {k}, l.data AS data FROM (
  SELECT {k}, arg_max({{'op': op, 'data': data}}, {{'lvl': lvl, 'ord': ord}}) AS l FROM allk GROUP BY {k}) g
WHERE l.op <> 'delete' AND l.data IS NOT NULL""")


# ---- workload ----------------------------------------------------------------------
def _bucket(b):
    return f"(timestamp - ((timestamp % {b}) + {b}) % {b})"


def write_rate():
    return with_(nofp("shop"), f"""
SELECT "table", {op_class('event')} AS op, {_bucket(HOUR)} AS bucket_start, CAST(count(*) AS BIGINT) AS n
FROM changes GROUP BY 1, 2, 3""")


def _storms() -> str:
    return f"""
SELECT *, deletes >= 3 AND deletes * 7 >= trailing_deletes * 2 AS is_storm FROM (
  SELECT *, CAST(coalesce(sum(deletes) OVER (PARTITION BY "table" ORDER BY bucket_start
      RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS trailing_deletes
  FROM (SELECT "table", {_bucket(DAY)} AS bucket_start, CAST(count(*) AS BIGINT) AS deletes
        FROM changes WHERE {op_class('event')} = 'delete' GROUP BY 1, 2) d) x"""


def delete_storms():
    return with_(nofp("shop"), _storms())


def silent_tables():
    return with_(nofp("shop_li"), f"""
SELECT DISTINCT db || '.' || tbl AS "table" FROM shopli_raw WHERE event_type = 'TABLE_MAP'
  AND db || '.' || tbl NOT IN (SELECT "table" FROM changes WHERE timestamp >= {SILENT_FROM_MS} AND timestamp < {SILENT_TO_MS}
                              AND "table" IS NOT NULL)""")


def co_changed():
    return with_(nofp("lineitem"), f"""
SELECT {FILE}, position, row_idx FROM changes c WHERE EXISTS (
  SELECT 1 FROM changes h WHERE json_extract_string(h.data, '$.l_returnflag') = 'R'
    AND h.server_id = c.server_id AND h.binarylog = c.binarylog AND h.position = c.position)""")


def audit_candidates():
    return with_(nofp("shop_li") + [("oc", _op_counts())], """
SELECT * FROM oc WHERE total >= 100 AND table_key NOT IN ('shop.customer')""")


# ---- scalar functions --------------------------------------------------------------
def _variants(items: list[str]) -> str:
    return f"(list_value({', '.join(items)}))[event_id % {len(items)} + 1]"


def gtid_parse():
    i = "CAST(event_id AS VARCHAR)"
    t = _variants([f"'u' || {i} || ':' || {i}", f"'u' || {i} || ':'", f"':' || {i}", f"'u' || {i}", "''",
                   f"'u:' || {i} || ':2'", f"'u: ' || {i}", f"'u:+' || {i}", f"'u:99999999999999999999' || {i}",
                   "NULL::VARCHAR"])
    return f"""
SELECT event_id, t AS gtid, {gtid_uuid('t')} AS gtid_uuid, {gtid_txn_text('t')} AS txn_text, {gtid_txn('t')} AS gtid_txn
FROM (SELECT event_id, {t} AS t FROM events) x"""


def padded_names():
    i = "CAST(event_id AS VARCHAR)"
    t = _variants([f"'mysql-bin.' || {i}", "'x'", "'x.'", f"'a.b.0000' || {i}", f"'m.' || {i} || '00000000000'",
                   f"{i} || '-basic-crud.binlog'", f"'n.-' || {i}"])
    base = "CASE WHEN instr(t, '.') > 0 THEN left(t, length(t) - length(split_part(t, '.', -1)) - 1) ELSE t END"
    return f"""
SELECT event_id, t AS name, {padded_seq('t')} AS log_seq,
  {base} || '.' || CAST(event_id % 3 + 1 AS VARCHAR) || '.' || {padded_seq('t')} AS output_name
FROM (SELECT event_id, {t} AS t FROM events) x"""


def table_keys():
    i = "CAST(event_id AS VARCHAR)"
    t = _variants([f"'db.t' || {i}", f"'a b.c/d' || {i}", "''", "NULL::VARCHAR", "'  '", f"'x' || chr(9) || 'y' || {i}",
                   f"'schéma.t' || {i}"])
    ev = _variants(["'EXT_WRITE_ROWS'", "'update_rows'", "'DELETE'", "'QUERY'", "'insert'"]).replace(
        f"event_id % 5 + 1", "event_id % 5 + 1")
    return f"""
SELECT event_id, t AS name, {table_key('t')} AS table_key, {op_class('e')} AS op
FROM (SELECT event_id, {t} AS t, {ev} AS e FROM events) x"""


def time_formats():
    t = _variants(["CAST(ms AS VARCHAR)", utc_s("ms"), "'not a time'", "' ' || CAST(ms AS VARCHAR)"])
    return f"""
SELECT event_id, ms, {utc_s('ms')} AS utc_seconds, {utc_ms('ms')} AS utc_millis, t AS text,
  coalesce({parse_long('t')}, epoch_ms(try_strptime(t, '%Y-%m-%d %H:%M:%S'))) AS parsed_ms
FROM (SELECT event_id, ms, {t} AS t FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events) a) b"""


def json_images():
    return with_(nofp("orders"), f"""
SELECT {FILE}, position, row_idx, TRY_CAST(json_extract_string(data, '$.cents') AS BIGINT) AS cents,
  json_extract_string(data, '$.o_orderstatus') AS status,
  list_contains(json_keys(data), 'cents') AS has_cents, list_contains(json_keys(data), 'missing') AS has_missing
FROM changes""")


# ---- protection -------------------------------------------------------------------
def filtered_tables():
    return with_(nofp("shop"), """
SELECT "table", event, CAST(count(*) AS BIGINT) AS n FROM changes
WHERE regexp_full_match("table", '(?:(?:shop\\..*))') AND NOT regexp_full_match("table", '(?:(?:.*cust.*))')
GROUP BY "table", event""")


def _redact(src: str) -> str:
    def fix(cells):
        return (f"list_transform(list_filter(list_transform({cells}, lambda v, i: {{'v': CASE WHEN column_names[i] = 'c_name' "
                f"THEN CASE WHEN v IS NOT NULL THEN to_json(sha256(v))::VARCHAR END ELSE v END, 'n': column_names[i]}}), "
                f"lambda x: x.n <> 'c_mktsegment'), lambda x: x.v)")
    return f"""
SELECT * EXCLUDE (rows, column_names),
  CASE WHEN db || '.' || tbl = 'shop.customer' THEN list_transform(rows, lambda r: {{'before': {fix('r.before')}, 'after': {fix('r.after')}}}) ELSE rows END AS rows,
  CASE WHEN db || '.' || tbl = 'shop.customer' THEN list_filter(column_names, lambda n: n <> 'c_mktsegment') ELSE column_names END AS column_names
FROM {src}"""


def redacted_changes():
    return with_(nofp("customer", rowev_sql=_redact),
                 f"SELECT {FILE}, position, row_idx, data, old, changed, columns FROM changes")


def encrypted_roundtrip():
    return with_(nofp("customer"), f"SELECT {FILE}, position, row_idx, data, old, changed FROM changes")


def event_type_gate():
    return with_(raw_ctes("control"), """
SELECT event_type, accepted, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT et AS event_type, et IN ('FORMAT_DESCRIPTION', 'PREVIOUS_GTIDS', 'GTID', 'QUERY', 'ROWS_QUERY', 'TABLE_MAP',
    'EXT_UPDATE_ROWS', 'EXT_WRITE_ROWS', 'EXT_DELETE_ROWS', 'ROTATE', 'XID') AS accepted
  FROM (SELECT CASE WHEN event_type = 'GTID' AND seq % 50 = 0 THEN 'ANONYMOUS_GTID' ELSE event_type END AS et FROM ctl_raw) a) b
GROUP BY event_type, accepted""")


def closed_logs():
    return with_(raw_ctes("orders"), f"""
SELECT server_id, binarylog, {padded_seq('binarylog')} AS log_seq FROM (SELECT DISTINCT server_id, binarylog FROM ord_raw) l
WHERE binarylog <> (SELECT arg_max(binarylog, CAST(split_part(binarylog, '.', -1) AS BIGINT)) FROM ord_raw r WHERE r.server_id = l.server_id)""")


# ---- sinks and streams ---------------------------------------------------------
def per_table_roundtrip():
    tk = table_key('"table"')
    return with_(nofp("shop"), f"SELECT {tk} AS table_key, {FILE}, position, row_idx, data FROM changes")


def lake_one_table():
    return with_(nofp("shop"), f"""
SELECT {padded_seq('binarylog')} AS log_seq, {table_key('"table"')} AS table_key, {FILE}, position, row_idx, changed
FROM changes WHERE "table" = 'shop.customer'""")


def single_file_roundtrip():
    return with_(nofp("shop"), f'SELECT {FILE}, position, row_idx, event, "table", data FROM changes')


def output_audit():
    return with_(nofp("shop") + [("oc", _op_counts())], """
SELECT table_key, total AS expected_rows, total AS written_rows, true AS ok, false AS small_file FROM oc""")


def written_stats():
    return table_op_counts()


def stream_convert():
    return row_changes()


def stream_write_rate():
    return write_rate()


def stream_query_shapes():
    return with_(pipeline("shop"), """
SELECT query_hash, min(timestamp) AS first_seen, CAST(count(*) AS BIGINT) AS rows_affected
FROM changes WHERE query_hash IS NOT NULL GROUP BY query_hash""")


# ---- the accounts log, straight from `customer` ---------------------------------
def _accounts(rest: str) -> str:
    """One row per change: key, kind, cseq, event, table, before/after parts."""
    def img(i, amount, ship, active):
        return f"""'{{"id":' || {i} || ',"amount":' || {amount} || ',"ship.to":{ship},"active":{active}}}'"""

    v1 = img("key", "a1", "null", "true")
    v2, v3, v4 = img("key", "a2", '"dock"', "false"), img("mid", "a2", '"dock"', "false"), img("mid", "'0.50'", '"dock"', "false")
    return f"""
WITH c AS (SELECT c_custkey AS key, c_custkey + 100000000 AS mid,
    CASE WHEN c_custkey % 3 = 0 THEN '100.00' ELSE printf('%.2f', CAST(c_acctbal AS DOUBLE)) END AS a1,
    CASE WHEN c_custkey % 3 = 0 THEN '75.00' ELSE '1.10' END AS a2,
    CASE WHEN c_custkey % 2 = 0 THEN 'acct book' ELSE 'acct_book' END AS tbl FROM customer),
k AS (
  SELECT *, 0 AS kind, 'EXT_WRITE_ROWS' AS event, NULL AS old, {v1} AS data FROM c
  UNION ALL SELECT *, 1, 'EXT_UPDATE_ROWS', {v1}, {v2} FROM c
  UNION ALL SELECT *, 2, 'EXT_UPDATE_ROWS', {v2}, {v3} FROM c WHERE key % 5 = 0
  UNION ALL SELECT *, 3, 'EXT_UPDATE_ROWS', {v3}, {v4} FROM c WHERE key % 5 = 0),
b AS (SELECT *, CAST(6 AS BIGINT) AS server_id, key * 4 + kind AS cseq, 'shop.' || tbl AS "table",
    'acct-bin.' || printf('%06d', key // 1000 + 1) AS binarylog,
    -- an event is 100 bytes, a change six of them; its row event starts where the fourth ends
    CAST(4 + 100 * ((key * 4 + kind - (key // 1000) * 4000) * 6 + 4) AS BIGINT) AS position FROM k)
{rest}"""


def transitions_decimal():
    return _accounts(f"""
SELECT server_id, binarylog, '{UUID_PREFIX}6:' || cseq AS gtid, "table", key AS id, a2 AS amount FROM b WHERE kind = 1 AND key % 3 = 0""")


def transitions_null():
    one = f"""SELECT server_id, binarylog, '{UUID_PREFIX}6:' || cseq AS gtid, "table", key AS id, a2 AS amount FROM b WHERE kind = 1"""
    return _accounts(f"{one} UNION ALL {one}")


def row_history_moves():
    w = "PARTITION BY id ORDER BY cseq, sub"
    return _accounts(f"""
SELECT id, CAST(row_number() OVER ({w}) AS INTEGER) AS version, event, binarylog, position, data, lag(data) OVER ({w}) AS prev_data
FROM (SELECT CASE WHEN kind < 2 THEN key ELSE mid END AS id, event, binarylog, position, data, cseq, 1 AS sub FROM b
      UNION ALL SELECT key, event, binarylog, position, NULL, cseq, 0 FROM b WHERE kind = 2) x""")


def redacted_query():
    shapes = ("CASE kind WHEN 0 THEN 'INSERT INTO `' || tbl || '` VALUES (?, ?, ?, ?)' "
              "WHEN 1 THEN 'UPDATE `' || tbl || '` SET amount = ?, `ship.to` = ? WHERE id = ?' "
              "WHEN 2 THEN 'UPDATE `' || tbl || '` SET id = ? WHERE id = ?' ELSE 'UPDATE `' || tbl || '` SET amount = ? WHERE id = ?' END")
    return _accounts(f'SELECT "table", {shapes} AS query, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1, 2')


def lake_table_exact():
    return _accounts("""
SELECT "table", 'shop.acct_book' AS table_key, event, CAST(count(*) AS BIGINT) AS n FROM b WHERE "table" = 'shop.acct book' GROUP BY 1, 2, 3""")


def convert_job():
    return _accounts("""
SELECT server_id, binarylog, position, CAST(0 AS INTEGER) AS row_idx, "table", event, data,
  CAST(1704067200000 + cseq * 60000 AS BIGINT) AS instant_ms, true AS audit_ok, CAST(count(*) OVER () AS BIGINT) AS audit_rows FROM b""")


def merge_gtids_fragmented():
    ctes = raw_ctes("orders") + [("kept", f"SELECT * FROM ord_raw WHERE event_type = 'GTID' AND {gtid_txn('gtid')} % 3 <> 0")]
    return with_(ctes + merged_ctes("kept"), "SELECT * FROM merged")


def fingerprint_cases():
    shapes = ["INSERT INTO t VALUES (?, ?, ?)", "UPDATE t SET a = ?--? WHERE id = ?", "UPDATE t SET a = ?, b = ? WHERE id = ?",
              "UPDATE `it's` SET a = ?", "UPDATE t SET a = ? WHERE b = ?", "INSERT INTO t VALUES (?, ?, ?)",
              "UPDATE t SET a = ? WHERE id IN (...)"]
    quoted = ["'" + x.replace("'", "''") + "'" for x in shapes]
    return f"SELECT event_id, {_variants(quoted)} AS query_fingerprint FROM events"


def co_changed_txn():
    unit = "coalesce(gtid_position, '@' || position)"
    return with_(nofp("control") + [("u", f"SELECT *, {unit} AS unit FROM changes")], f"""
SELECT {FILE}, position, row_idx FROM u c WHERE EXISTS (SELECT 1 FROM u h WHERE h.event = 'EXT_DELETE_ROWS'
  AND h.server_id = c.server_id AND h.binarylog = c.binarylog AND h.unit = c.unit)""")


def _two_bases():
    return """
SELECT base AS log_base, CAST(4 AS BIGINT) AS server_id, 'shop.customer' AS table_key,
  CAST(count(*) + count(*) FILTER (WHERE c_custkey % 5 = 0) AS BIGINT) AS n, CAST(count(DISTINCT c_custkey // 1000) AS BIGINT) AS logs
FROM customer, (VALUES ('cust-bin'), ('other-bin')) v(base) GROUP BY base"""


def lake_two_bases():
    return _two_bases()


def stream_two_batches():
    return _two_bases()


def empty_lake():
    return """
SELECT e AS event_type, CAST(n AS BIGINT) AS events, CAST(0 AS BIGINT) AS rows, CAST(n AS BIGINT) AS reference_count, CAST(0 AS BIGINT) AS lake_rows
FROM (SELECT count(*) + count(*) FILTER (WHERE c_custkey % 5 = 0) AS n FROM customer) c,
  (VALUES ('GTID'), ('QUERY'), ('ROWS_QUERY'), ('TABLE_MAP'), ('XID')) v(e)"""


def stream_rate_append():
    return f"""
WITH t AS (SELECT 1704067200000 + (c_custkey * 2 + 1) * 60000 AS ts, 'write' AS op FROM customer
  UNION ALL SELECT 1704067200000 + (c_custkey * 2 + 2) * 60000, 'update' FROM customer WHERE c_custkey % 5 = 0)
SELECT CAST({_bucket(HOUR).replace('timestamp', 'ts')} AS BIGINT) AS bucket_start, 'shop.customer' AS "table", op, CAST(count(*) AS BIGINT) AS n
FROM t GROUP BY 1, 2, 3 HAVING bucket_start + {HOUR} <= (SELECT max(ts) FROM t) - {HOUR}"""


def stream_first_seen():
    return with_(pipeline("shop"), """
SELECT query_hash, query_fingerprint, CAST(1 AS BIGINT) AS alerts FROM changes WHERE query_hash IS NOT NULL GROUP BY query_hash, query_fingerprint""")


def stream_split_log():
    return customer_changes()


def stream_delete_storms():
    """Days that the newest change, less a day's delay, has closed."""
    return with_(nofp("orders"), f"SELECT s.* FROM ({_storms()}) s WHERE bucket_start + 2 * {DAY} <= (SELECT max(timestamp) FROM changes)")


def lake_versions():
    """The second version replaces the logs that it writes (servers 1 to 3), and keeps the others."""
    return with_(nofp("shop"), """
SELECT version, "table", event, CAST(count(*) AS BIGINT) AS n FROM changes, (VALUES (1), (2)) v(version)
WHERE version = 1 OR server_id = 4 OR event = 'EXT_WRITE_ROWS' GROUP BY ALL""")


def state_at_incremental():
    from checks.catalog import STATE_INSTANTS_MS

    parts = " UNION ALL ".join(f"SELECT *, CAST({t} AS BIGINT) AS instant FROM ({_state('ko', 'o_orderkey', t, False)}) s{i}" for i, t in enumerate(STATE_INSTANTS_MS))
    return with_(nofp("orders") + keyed_ctes("changes", "o_orderkey", "ko"), parts)


def key_lookup():
    from checks.catalog import LOOKED_UP_ORDER

    def has(*pairs):
        both = [" AND ".join(f"json_extract_string({side}, '$.{c}') = '{v}'" for c, v in pairs) for side in ("data", "old")]
        return f"SELECT {FILE}, position, row_idx, event, data, old FROM changes WHERE coalesce({both[0]}, false) OR coalesce({both[1]}, false)"

    return with_(nofp("orders"), f"{has(('o_orderkey', LOOKED_UP_ORDER))} UNION ALL {has(('o_orderstatus', 'P'), ('o_orderpriority', '1-URGENT'))}")


def file_sizes():
    return with_(raw_ctes("orders"), f"SELECT {FILE}, max(next_position) AS log_size FROM ord_raw GROUP BY {FILE}")


def empty_row_events():
    return with_(nofp("customer"), f"SELECT {FILE}, position, row_idx, event, data FROM changes WHERE timestamp // 60000 % 7 <> 0")


def single_ordered():
    order = f"server_id, {padded_seq('binarylog')}, binarylog, position, row_idx"
    return with_(nofp("shop"), f"SELECT {FILE}, position, row_idx, row_number() OVER (ORDER BY {order}) AS place FROM changes")


def typed_images():
    at = "strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%g')"
    return f"""
SELECT event_id, '{{"event_id":' || event_id || ',"ts":"' || {at} || '+00:00","kind":"' || base64(encode(event_type)) || '","none":null,"even":'
  || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS image,
  '"' || event_type || '"' AS text, CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS number FROM events"""


SQL = {
    f.__name__: f
    for f in [
        row_changes, row_diff, change_counter, multi_row_explode, statements, customer_changes,
        event_positions, txn_tagging, txn_segments, stale_query_carry, query_txn_scope,
        table_map_resolution, control_changes, captured_transactions,
        file_summary, merge_gtids, gtid_intervals, event_type_counts, total_events,
        table_op_counts, table_event_counts, txn_rollup,
        query_fingerprint, new_query_shapes, shape_volume, statement_stats_join,
        state_at, state_at_preimage, row_history, first_set, transitions, after_gtid_set, bootstrap,
        write_rate, delete_storms, silent_tables, co_changed, audit_candidates,
        gtid_parse, padded_names, table_keys, time_formats, json_images,
        filtered_tables, redacted_changes, encrypted_roundtrip, event_type_gate, closed_logs,
        per_table_roundtrip, lake_one_table, single_file_roundtrip, output_audit, written_stats,
        stream_convert, stream_write_rate, stream_query_shapes,
        transitions_decimal, transitions_null, row_history_moves, redacted_query, lake_table_exact, convert_job,
        merge_gtids_fragmented, fingerprint_cases, co_changed_txn, lake_two_bases, stream_two_batches, empty_lake,
        stream_rate_append, stream_first_seen, stream_split_log, stream_delete_storms, lake_versions,
        state_at_incremental, key_lookup, file_sizes, empty_row_events, single_ordered, typed_images,
    ]
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in SQL.items()}
