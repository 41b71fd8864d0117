"""CTE builders: fixture logs, sequencing, table maps, explosion."""
from __future__ import annotations

UUID_PREFIX = "3e11fa47-71ca-11e1-9e33-c80aa942956"
ROW_TYPES = "('EXT_WRITE_ROWS','EXT_UPDATE_ROWS','EXT_DELETE_ROWS')"

RAW_COLS = (
    "server_id, binarylog, seq, next_position, event_type, timestamp, gtid, previous_gtids, "
    "next_binlog, query, table_id, db, tbl, column_names, rows"
)


def ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def j(col: str) -> str:
    """JSON literal text of a string value."""
    return f"to_json({col})::VARCHAR"


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes)
    return f"WITH {body}\n{final}"


def _expand(src: str, with_begin: bool = True) -> str:
    kinds = ["GTID", "QUERY", "ROWS_QUERY", "TABLE_MAP", "ROW", "XID"]
    if not with_begin:
        kinds.remove("QUERY")
    n = len(kinds)
    vals = ", ".join(f"({i}, '{k}')" for i, k in enumerate(kinds))
    return f"""
SELECT CAST(server_id AS BIGINT) AS server_id, binarylog,
  CAST(cseq * {n} + k AS BIGINT) AS seq,
  CAST(4 + 100 * (cseq * {n} + k - file_base * {n} + 1) AS BIGINT) AS next_position,
  CASE WHEN ek = 'ROW' THEN etype ELSE ek END AS event_type,
  CAST(ts AS BIGINT) AS timestamp,
  CASE WHEN ek = 'GTID' THEN '{UUID_PREFIX}' || CAST(server_id AS VARCHAR) || ':' || CAST(txn AS VARCHAR) END AS gtid,
  NULL::VARCHAR AS previous_gtids, NULL::VARCHAR AS next_binlog,
  CASE WHEN ek = 'ROWS_QUERY' THEN stmt END AS query,
  CASE WHEN ek IN ('TABLE_MAP', 'ROW') THEN CAST(table_id AS BIGINT) END AS table_id,
  CASE WHEN ek = 'TABLE_MAP' THEN db END AS db,
  CASE WHEN ek = 'TABLE_MAP' THEN tbl END AS tbl,
  CASE WHEN ek = 'TABLE_MAP' THEN column_names END AS column_names,
  CASE WHEN ek = 'ROW' THEN rows END AS rows
FROM {src}, (VALUES {vals}) AS kk(k, ek)"""


def _one(before: str, after: str) -> str:
    return f"[{{'before': {before}, 'after': {after}}}]"


NULL_ARR = "NULL::VARCHAR[]"


def orders_ctes(prefix: str = "ord") -> list[tuple[str, str]]:
    img_o = f"[CAST(key AS VARCHAR), '\"O\"', CAST(cents AS VARCHAR), {j('prio')}]"
    img_st = f"[CAST(key AS VARCHAR), {j('st')}, CAST(cents AS VARCHAR), {j('prio')}]"
    k = "CAST(key AS VARCHAR)"
    insert = (
        "(CASE WHEN key % 11 = 0 THEN '/* app:web */ ' ELSE '' END) || "
        "'INSERT INTO orders (o_orderkey, o_orderstatus, cents, o_orderpriority) VALUES (' || "
        f"{k} || ', ''O'', ' || CAST(cents AS VARCHAR) || ', ''' || prio || ''')'"
    )
    update = (
        "CASE WHEN key % 7 = 0 THEN 'UPDATE orders SET o_orderstatus = ''' || st || "
        f"''' WHERE o_orderkey IN (' || {k} || ', ' || CAST(key + 1 AS VARCHAR) || ') -- batch' "
        f"ELSE 'UPDATE orders SET o_orderstatus = ''' || st || ''' WHERE o_orderkey = ' || {k} END"
    )
    delete = f"'DELETE FROM orders WHERE o_orderkey = ' || {k} || ' AND o_orderstatus <> ''X'''"
    return [
        (f"{prefix}_src", f"""
SELECT o_orderkey AS key, o_orderstatus AS st, o_orderpriority AS prio,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents, {ms('o_orderdate')} AS base_ms
FROM orders"""),
        (f"{prefix}_k", f"""
SELECT key, 1 AS kind, 'EXT_WRITE_ROWS' AS etype, base_ms AS ts, {_one(NULL_ARR, img_o)} AS rows, {insert} AS stmt
FROM {prefix}_src
UNION ALL
SELECT key, 2, 'EXT_UPDATE_ROWS', base_ms + (key % 30 + 1) * CAST(86400000 AS BIGINT), {_one(img_o, img_st)}, {update}
FROM {prefix}_src WHERE st <> 'O'
UNION ALL
SELECT key, 3, 'EXT_DELETE_ROWS', base_ms + 60 * CAST(86400000 AS BIGINT), {_one(img_st, NULL_ARR)}, {delete}
FROM {prefix}_src WHERE key % 17 = 0"""),
        (f"{prefix}_c", f"""
SELECT key % 3 + 1 AS server_id,
  'mysql-bin.' || printf('%06d', key // 3 // 500 + 8) AS binarylog,
  (key // 3) * 3 + kind AS cseq, (key // 3) * 3 + kind AS txn,
  (key // 3 // 500) * 500 * 3 AS file_base, ts, etype, stmt, rows, key, kind,
  101 AS table_id, 'shop' AS db, 'orders' AS tbl,
  ['o_orderkey', 'o_orderstatus', 'cents', 'o_orderpriority'] AS column_names
FROM {prefix}_k"""),
        (f"{prefix}_raw", _expand(f"{prefix}_c")),
    ]


def customer_ctes(prefix: str = "cus") -> list[tuple[str, str]]:
    k = "CAST(key AS VARCHAR)"
    img = f"[{k}, {j('name')}, CAST(bal AS VARCHAR), {j('seg')}]"
    img2 = f"[{k}, {j('name')}, CAST(bal + 100 AS VARCHAR), {j('seg')}]"
    ins = (
        "'INSERT INTO customer (c_custkey, c_name, balance_cents, c_mktsegment) VALUES (' || "
        f"{k} || ', ''' || name || ''', ' || CAST(bal AS VARCHAR) || ', ''' || seg || ''')'"
    )
    upd = f"'UPDATE customer SET balance_cents = balance_cents + 100 WHERE c_custkey = ' || {k}"
    return [
        (f"{prefix}_src", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS seg, CAST(round(c_acctbal * 100) AS BIGINT) AS bal
FROM customer"""),
        (f"{prefix}_k", f"""
SELECT key, 1 AS kind, 'EXT_WRITE_ROWS' AS etype, {_one(NULL_ARR, img)} AS rows, {ins} AS stmt FROM {prefix}_src
UNION ALL
SELECT key, 2, 'EXT_UPDATE_ROWS', {_one(img, img2)}, {upd} FROM {prefix}_src WHERE key % 5 = 0"""),
        (f"{prefix}_c", f"""
SELECT 4 AS server_id, 'cust-bin.' || printf('%06d', key // 1000 + 1) AS binarylog,
  key * 2 + kind AS cseq, key * 2 + kind AS txn, (key // 1000) * 1000 * 2 AS file_base,
  CAST(1704067200000 AS BIGINT) + (key * 2 + kind) * 60000 AS ts, etype, stmt, rows,
  102 AS table_id, 'shop' AS db, 'customer' AS tbl,
  ['c_custkey', 'c_name', 'balance_cents', 'c_mktsegment'] AS column_names
FROM {prefix}_k"""),
        (f"{prefix}_raw", _expand(f"{prefix}_c")),
    ]


def lineitem_ctes(prefix: str = "li") -> list[tuple[str, str]]:
    after = (
        "[CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), "
        "CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), "
        f"CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), {j('l_returnflag')}, {j('l_linestatus')}]"
    )
    order = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")
    return [
        (f"{prefix}_r", f"""
SELECT l_orderkey, l_shipdate, {after} AS after,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn
FROM lineitem"""),
        (f"{prefix}_e", f"""
SELECT l_orderkey,
  list({{'before': {NULL_ARR}, 'after': after}} ORDER BY rn) AS rows,
  'INSERT INTO lineitem VALUES ' || array_to_string(list('(' || array_to_string(after, ', ') || ')' ORDER BY rn), ', ') AS stmt,
  min(l_shipdate) AS ship
FROM {prefix}_r GROUP BY l_orderkey"""),
        (f"{prefix}_c", f"""
SELECT 5 AS server_id, 'line-bin.' || printf('%06d', l_orderkey // 2000 + 1) AS binarylog,
  l_orderkey AS cseq, l_orderkey AS txn, (l_orderkey // 2000) * 2000 AS file_base,
  {ms('ship')} AS ts, 'EXT_WRITE_ROWS' AS etype, stmt, rows,
  103 AS table_id, 'shop' AS db, 'lineitem' AS tbl,
  ['l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', 'l_quantity', 'price_cents', 'l_returnflag', 'l_linestatus'] AS column_names
FROM {prefix}_e"""),
        (f"{prefix}_raw", _expand(f"{prefix}_c", with_begin=False)),
    ]


def control_ctes(prefix: str = "ctl") -> list[tuple[str, str]]:
    img = "[CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(cents AS VARCHAR)]"
    img2 = "[CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(cents + user_id % 3 AS VARCHAR)]"
    return [
        (f"{prefix}_e", f"""
SELECT event_id, user_id, {ms('ts')} AS t, CAST(round(value * 100) AS BIGINT) AS cents,
  CASE event_type WHEN 'signup' THEN 'GTID' WHEN 'view' THEN 'TABLE_MAP' WHEN 'click' THEN 'ROWS_QUERY'
    WHEN 'error' THEN 'XID'
    WHEN 'purchase' THEN (['EXT_WRITE_ROWS', 'EXT_UPDATE_ROWS', 'EXT_DELETE_ROWS'])[event_id % 3 + 1] END AS et
FROM events"""),
        (f"{prefix}_body", f"""
SELECT user_id % 2 + 1 AS server_id, 'mysql-bin.' || CAST(user_id % 4 AS VARCHAR) AS binarylog,
  event_id AS seq, 1104 + event_id * 100 AS next_position, et AS event_type, t AS timestamp,
  CASE WHEN et = 'GTID' THEN '{UUID_PREFIX}' || CAST(user_id % 2 + 1 AS VARCHAR) || ':' || CAST(event_id AS VARCHAR) END AS gtid,
  NULL::VARCHAR AS previous_gtids, NULL::VARCHAR AS next_binlog,
  CASE WHEN et = 'ROWS_QUERY' THEN 'UPDATE t SET v = ' || CAST(event_id AS VARCHAR) || ' WHERE id = ' || CAST(user_id AS VARCHAR) END AS query,
  CASE WHEN et = 'TABLE_MAP' OR et LIKE 'EXT_%' THEN user_id % 5 END AS table_id,
  CASE WHEN et = 'TABLE_MAP' THEN 'shop' END AS db,
  CASE WHEN et = 'TABLE_MAP' THEN 't' || CAST(user_id % 5 AS VARCHAR) || '_v' || CAST(event_id % 3 AS VARCHAR) END AS tbl,
  CASE WHEN et = 'TABLE_MAP' THEN ['id', 'user_id', 'cents'] END AS column_names,
  CASE et WHEN 'EXT_WRITE_ROWS' THEN {_one(NULL_ARR, img)}
    WHEN 'EXT_UPDATE_ROWS' THEN {_one(img, img2)}
    WHEN 'EXT_DELETE_ROWS' THEN {_one(img, NULL_ARR)} END AS rows
FROM {prefix}_e"""),
        (f"{prefix}_files", f"""
SELECT user_id % 4 AS f, min(t) AS t0, max(t) AS t1, max(event_id) AS last FROM {prefix}_e GROUP BY user_id % 4"""),
        (f"{prefix}_raw", f"""
SELECT CAST(server_id AS BIGINT) AS server_id, binarylog, CAST(seq AS BIGINT) AS seq,
  CAST(next_position AS BIGINT) AS next_position, event_type, CAST(timestamp AS BIGINT) AS timestamp,
  gtid, previous_gtids, next_binlog, query, CAST(table_id AS BIGINT) AS table_id, db, tbl, column_names, rows
FROM {prefix}_body
UNION ALL
SELECT f % 2 + 1, 'mysql-bin.' || CAST(f AS VARCHAR), -2, 126, 'FORMAT_DESCRIPTION', t0,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {prefix}_files
UNION ALL
SELECT f % 2 + 1, 'mysql-bin.' || CAST(f AS VARCHAR), -1, 197, 'PREVIOUS_GTIDS', t0,
  NULL, '{UUID_PREFIX}' || CAST(f % 2 + 1 AS VARCHAR) || ':1-' || CAST(f + 100 AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM {prefix}_files WHERE f <> 3
UNION ALL
SELECT f % 2 + 1, 'mysql-bin.' || CAST(f AS VARCHAR), last + 1, 4, 'ROTATE', t1,
  NULL, NULL, 'mysql-bin.' || CAST(f + 4 AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL
FROM {prefix}_files WHERE f <> 2"""),
    ]


def seq_ctes(raw: str, out: str, query_scope: str = "file") -> list[tuple[str, str]]:
    """Plain per-file window sequencing (the reference rule, no buckets)."""
    w = "PARTITION BY server_id, binarylog ORDER BY seq"
    q = (
        f"last_value(query IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        if query_scope == "file"
        else f"last_value(CASE WHEN query IS NOT NULL THEN {{'s': segment, 'q': query}} END IGNORE NULLS) "
        f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return [
        (f"{out}_1", f"""
SELECT *, lag(next_position, 1, 4) OVER ({w}) AS position,
  sum(CASE WHEN event_type = 'GTID' THEN 1 ELSE 0 END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment,
  coalesce(sum(CASE WHEN event_type IN {ROW_TYPES} THEN coalesce(len(rows), 0) ELSE 0 END)
    OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rows_before
FROM {raw}"""),
        (f"{out}_2", f"""
SELECT *, last_value(CASE WHEN event_type = 'GTID' THEN {{'k': 1, 'g': gtid, 'p': position}}
    WHEN event_type = 'XID' THEN {{'k': 0, 'g': NULL::VARCHAR, 'p': NULL::BIGINT}} END IGNORE NULLS)
    OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m,
  {q} AS lq
FROM {out}_1"""),
        (out, f"""
SELECT * EXCLUDE (m, lq),
  CASE WHEN m.k = 1 THEN m.g END AS txn_gtid,
  CASE WHEN m.k = 1 THEN CAST(m.p AS VARCHAR) END AS txn_position,
  {"lq" if query_scope == "file" else "CASE WHEN lq.s = segment THEN lq.q END"} AS last_query
FROM {out}_2"""),
    ]


def rowev_ctes(seq: str, out: str) -> list[tuple[str, str]]:
    return [
        (f"{out}_maps", f"""
SELECT server_id, binarylog, segment, table_id, arg_max({{'db': db, 'tbl': tbl, 'cols': column_names}}, seq) AS mp
FROM {seq} WHERE event_type = 'TABLE_MAP' GROUP BY server_id, binarylog, segment, table_id"""),
        (out, f"""
SELECT r.* EXCLUDE (db, tbl, column_names), m.mp.db AS db, m.mp.tbl AS tbl, m.mp.cols AS column_names
FROM {seq} r LEFT JOIN {out}_maps m
  ON r.server_id = m.server_id AND r.binarylog = m.binarylog AND r.segment = m.segment AND r.table_id = m.table_id
WHERE r.event_type IN {ROW_TYPES}"""),
    ]


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The shapes of the statements that the fixture logs hold, by
# what the statement starts with (longest first), as literal text.
SHAPES = (
    ("/* app:web */ INSERT INTO orders", "INSERT INTO orders (o_orderkey, o_orderstatus, cents, o_orderpriority) VALUES (?, ?, ?, ?)"),
    ("INSERT INTO orders", "INSERT INTO orders (o_orderkey, o_orderstatus, cents, o_orderpriority) VALUES (?, ?, ?, ?)"),
    ("DELETE FROM orders", "DELETE FROM orders WHERE o_orderkey = ? AND o_orderstatus <> ?"),
    ("INSERT INTO customer", "INSERT INTO customer (c_custkey, c_name, balance_cents, c_mktsegment) VALUES (?, ?, ?, ?)"),
    ("UPDATE customer", "UPDATE customer SET balance_cents = balance_cents + ? WHERE c_custkey = ?"),
    ("INSERT INTO lineitem", "INSERT INTO lineitem VALUES (?, ?, ?, ?, ?, ?, ?, ?)"),
    ("UPDATE t SET", "UPDATE t SET v = ? WHERE id = ?"),
)


def fingerprint(col: str) -> str:
    """The expected shape, looked up by statement kind; no rewriting."""
    update = (f"WHEN starts_with({col}, 'UPDATE orders') AND contains({col}, ' IN (') THEN "
              "'UPDATE orders SET o_orderstatus = ? WHERE o_orderkey IN (...)' "
              f"WHEN starts_with({col}, 'UPDATE orders') THEN 'UPDATE orders SET o_orderstatus = ? WHERE o_orderkey = ?'")
    return "CASE " + update + " " + " ".join(f"WHEN starts_with({col}, {_sq(a)}) THEN {_sq(b)}" for a, b in SHAPES) + " END"


def gtid_uuid(g: str) -> str:
    return f"CASE WHEN instr({g}, ':') > 1 THEN split_part({g}, ':', 1) END"


def parse_long(t: str) -> str:
    return f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS BIGINT) END"


def gtid_txn_text(g: str) -> str:
    return f"CASE WHEN instr({g}, ':') > 0 AND instr({g}, ':') < length({g}) THEN substr({g}, instr({g}, ':') + 1) END"


def gtid_txn(g: str) -> str:
    return parse_long(gtid_txn_text(g))


def image(qn: str, cells: str) -> str:
    return (
        f"CASE WHEN {cells} IS NOT NULL THEN '{{' || array_to_string(list_transform({cells}, "
        f"lambda v, i: {qn}[i] || ':' || coalesce(v, 'null')), ',') || '}}' END"
    )


def changes_ctes(rowev: str, out: str, fingerprints: bool = True) -> list[tuple[str, str]]:
    fp = fingerprint("last_query") if fingerprints else "NULL::VARCHAR"
    return [
        (f"{out}_x", f"""
SELECT *, list_transform(column_names, lambda n: to_json(n)::VARCHAR) AS qn,
  {fp} AS fp,
  unnest(generate_series(0, len(rows) - 1)) AS row_idx
FROM {rowev}"""),
        (f"{out}_y", f"""
SELECT *, rows[row_idx + 1].before AS b, rows[row_idx + 1].after AS a FROM {out}_x"""),
        (f"{out}_z", f"""
SELECT *, CASE WHEN event_type = 'EXT_UPDATE_ROWS'
  THEN list_filter(range(1, len(a) + 1), lambda i: b[i] IS DISTINCT FROM a[i]) END AS idx
FROM {out}_y"""),
        (out, f"""
SELECT binarylog, position, txn_position AS gtid_position, txn_gtid AS gtid,
  {gtid_uuid('txn_gtid')} AS gtid_uuid, {gtid_txn('txn_gtid')} AS gtid_txn,
  server_id, timestamp, event_type AS event, db || '.' || tbl AS "table",
  last_query AS query, fp AS query_fingerprint, {"sha256(fp)" if fingerprints else "NULL::VARCHAR"} AS query_hash,
  CASE WHEN column_names IS NULL THEN NULL WHEN event_type = 'EXT_DELETE_ROWS' THEN {image('qn', 'b')} ELSE {image('qn', 'a')} END AS data,
  CASE WHEN column_names IS NOT NULL AND event_type IN ('EXT_UPDATE_ROWS', 'EXT_DELETE_ROWS') THEN {image('qn', 'b')} END AS old,
  CASE WHEN column_names IS NOT NULL AND event_type = 'EXT_UPDATE_ROWS' THEN '{{' || array_to_string(list_transform(idx,
    lambda i: qn[i] || ':{{"old":' || coalesce(b[i], 'null') || ',"new":' || coalesce(a[i], 'null') || '}}'), ',') || '}}' END AS changed,
  CASE WHEN column_names IS NULL THEN NULL WHEN event_type = 'EXT_UPDATE_ROWS' THEN to_json(list_transform(idx, lambda i: column_names[i]))::VARCHAR
    ELSE to_json(column_names)::VARCHAR END AS columns,
  CAST(row_idx AS INTEGER) AS row_idx, seq, segment, CAST(rows_before + row_idx + 1 AS BIGINT) AS counter
FROM {out}_z"""),
    ]


def pipeline(log: str, out: str = "changes", query_scope: str = "file", fingerprints: bool = True,
             rowev_sql=None) -> list[tuple[str, str]]:
    """Fixture log -> sequenced events (`{out}_seq`) -> row events -> `out`."""
    fixtures = {
        "orders": orders_ctes,
        "customer": customer_ctes,
        "lineitem": lineitem_ctes,
        "control": control_ctes,
    }
    ctes: list[tuple[str, str]] = []
    if log == "shop":
        ctes += orders_ctes() + customer_ctes()
        ctes.append(("shop_raw", "SELECT * FROM ord_raw UNION ALL SELECT * FROM cus_raw"))
        raw = "shop_raw"
    elif log == "shop_li":
        ctes += orders_ctes() + customer_ctes() + lineitem_ctes()
        ctes.append(("shopli_raw", "SELECT * FROM ord_raw UNION ALL SELECT * FROM cus_raw UNION ALL SELECT * FROM li_raw"))
        raw = "shopli_raw"
    else:
        ctes += fixtures[log]()
        raw = ctes[-1][0]
    ctes += seq_ctes(raw, f"{out}_seq", query_scope)
    ctes += rowev_ctes(f"{out}_seq", f"{out}_rowev")
    rowev = f"{out}_rowev"
    if rowev_sql:
        ctes.append((f"{out}_rowev2", rowev_sql(rowev)))
        rowev = f"{out}_rowev2"
    ctes += changes_ctes(rowev, out, fingerprints)
    return ctes


def raw_name(log: str) -> str:
    return {"orders": "ord_raw", "customer": "cus_raw", "lineitem": "li_raw", "control": "ctl_raw",
            "shop": "shop_raw", "shop_li": "shopli_raw"}[log]


def raw_ctes(log: str) -> list[tuple[str, str]]:
    if log == "shop":
        return orders_ctes() + customer_ctes() + [("shop_raw", "SELECT * FROM ord_raw UNION ALL SELECT * FROM cus_raw")]
    if log == "shop_li":
        return orders_ctes() + customer_ctes() + lineitem_ctes() + [
            ("shopli_raw", "SELECT * FROM ord_raw UNION ALL SELECT * FROM cus_raw UNION ALL SELECT * FROM li_raw")]
    return {"orders": orders_ctes, "customer": customer_ctes, "lineitem": lineitem_ctes, "control": control_ctes}[log]()


def op_class(e: str) -> str:
    return (f"CASE WHEN lower({e}) LIKE '%write%' OR lower({e}) LIKE '%insert%' THEN 'write' "
            f"WHEN lower({e}) LIKE '%update%' THEN 'update' WHEN lower({e}) LIKE '%delete%' THEN 'delete' END")


def table_key(t: str) -> str:
    return (f"CASE WHEN {t} IS NULL OR regexp_full_match({t}, '[\\x00-\\x20]*') THEN 'unknown_table' "
            f"ELSE regexp_replace({t}, '[^a-zA-Z0-9._-]', '_', 'g') END")


def padded_seq(n: str) -> str:
    tail = f"split_part({n}, '.', -1)"
    return (f"CASE WHEN instr({n}, '.') = 0 THEN '0000000000' "
            f"ELSE coalesce(printf('%010d', {parse_long(tail)}), '0000000000') END")


def utc_ms(c: str) -> str:
    return f"strftime(epoch_ms({c}), '%Y-%m-%d %H:%M:%S.%g')"


def utc_s(c: str) -> str:
    return f"strftime(epoch_ms({c}), '%Y-%m-%d %H:%M:%S')"
