"""Adapters: driver tables -> decoded event logs (the `raw_events` contract).

Each adapter turns rows of a driver table into the event sequence a server
would log for them (GTID, QUERY, ROWS_QUERY, TABLE_MAP, row event, XID), so
all operators run on data that grows with the driver tables. Every adapter is
a plain DataFrame job: no driver-side loops, no global window.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowlog.functions.images import cell_literal
from rowlog.functions.time import epoch_millis
from rowlog.schema import FILE, RAW_SCHEMA

# Fixed values of the fixtures.
UUID_PREFIX = "3e11fa47-71ca-11e1-9e33-c80aa942956"  # + one digit server id
DAY_MS = 86_400_000
ORDERS_PER_FILE = 500
CUSTOMERS_PER_FILE = 1000
LINE_ORDERS_PER_FILE = 2000
ORDERS_COLUMNS = ["o_orderkey", "o_orderstatus", "cents", "o_orderpriority"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "balance_cents", "c_mktsegment"]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "l_quantity", "price_cents", "l_returnflag", "l_linestatus",
]
ACCOUNT_COLUMNS = ["id", "amount", "ship.to", "active"]
ACCOUNT_TABLE_ID, ACCOUNT_MOVE = 200, 100_000_000
CONTROL_COLUMNS = ["id", "user_id", "cents"]
ORDERS_TABLE_ID, CUSTOMER_TABLE_ID, LINEITEM_TABLE_ID = 101, 102, 103
CUSTOMER_EPOCH_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _uuid(server: Column) -> Column:
    return F.concat(F.lit(UUID_PREFIX), server.cast("string"))


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _file_number(n: Column) -> Column:
    """Six digits at least; longer numbers stay whole."""
    return F.format_string("%06d", n)


def _conform(df: DataFrame) -> DataFrame:
    """Select the raw contract columns, typed, filling absent ones with null."""
    cols = []
    for f in RAW_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _expand_changes(changes: DataFrame, with_begin: bool = True) -> DataFrame:
    """One change (one row event) -> GTID, [QUERY], ROWS_QUERY, TABLE_MAP, row event, XID.

    `changes` has: server_id, binarylog, cseq, txn, ts, etype, stmt, table_id,
    db, tbl, column_names, rows, file_base (first cseq of its file)."""
    kinds = ["GTID", "QUERY", "ROWS_QUERY", "TABLE_MAP", "ROW", "XID"]
    if not with_begin:
        kinds.remove("QUERY")
    n = len(kinds)
    ex = changes.select("*", F.posexplode(F.array(*[F.lit(k) for k in kinds])).alias("_k", "_kind"))
    kind = F.col("_kind")
    seq = F.col("cseq") * n + F.col("_k")
    return _conform(
        ex.select(
            "server_id",
            "binarylog",
            seq.alias("seq"),
            (F.lit(4) + F.lit(100) * (seq - F.col("file_base") * n + 1)).alias("next_position"),
            F.when(kind == "ROW", F.col("etype")).otherwise(kind).alias("event_type"),
            F.col("ts").alias("timestamp"),
            F.when(kind == "GTID", F.concat(_uuid(F.col("server_id")), F.lit(":"), _s("txn"))).alias("gtid"),
            F.when(kind == "ROWS_QUERY", F.col("stmt")).alias("query"),
            F.when(kind.isin("TABLE_MAP", "ROW"), F.col("table_id")).alias("table_id"),
            F.when(kind == "TABLE_MAP", F.col("db")).alias("db"),
            F.when(kind == "TABLE_MAP", F.col("tbl")).alias("tbl"),
            F.when(kind == "TABLE_MAP", F.col("column_names")).alias("column_names"),
            F.when(kind == "ROW", F.col("rows")).alias("rows"),
        )
    )


def _one_row(before, after) -> Column:
    return F.array(F.struct(before.cast("array<string>").alias("before"), after.cast("array<string>").alias("after")))


def orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change list of the orders log: one row per row event.

    Every order is inserted with status O; orders whose final status is not O
    get an UPDATE to it; every 17th order is deleted. Server = key % 3 + 1;
    the order's changes follow each other in its server's log."""
    o = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("prio"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        epoch_millis("o_orderdate").alias("base_ms"),
    )
    key = F.col("key")
    k, cents, prio = _s(key), _s("cents"), cell_literal("prio")
    img_o = F.array(k, F.lit('"O"'), cents, prio)
    img_st = F.array(k, cell_literal("st"), cents, prio)
    insert = F.concat(
        F.when(key % 11 == 0, F.lit("/* app:web */ ")).otherwise(F.lit("")),
        F.lit("INSERT INTO orders (o_orderkey, o_orderstatus, cents, o_orderpriority) VALUES ("),
        k, F.lit(", 'O', "), cents, F.lit(", '"), F.col("prio"), F.lit("')"),
    )
    update = F.when(
        key % 7 == 0,
        F.concat(
            F.lit("UPDATE orders SET o_orderstatus = '"), F.col("st"),
            F.lit("' WHERE o_orderkey IN ("), k, F.lit(", "), _s(key + 1), F.lit(") -- batch"),
        ),
    ).otherwise(
        F.concat(F.lit("UPDATE orders SET o_orderstatus = '"), F.col("st"), F.lit("' WHERE o_orderkey = "), k)
    )
    delete = F.concat(F.lit("DELETE FROM orders WHERE o_orderkey = "), k, F.lit(" AND o_orderstatus <> 'X'"))
    k1 = o.select("key", F.lit(1).alias("kind"), F.lit("EXT_WRITE_ROWS").alias("etype"),
                  F.col("base_ms").alias("ts"), _one_row(F.lit(None), img_o).alias("rows"), insert.alias("stmt"))
    k2 = o.where(F.col("st") != "O").select(
        "key", F.lit(2).alias("kind"), F.lit("EXT_UPDATE_ROWS").alias("etype"),
        (F.col("base_ms") + (key % 30 + 1) * F.lit(DAY_MS)).alias("ts"),
        _one_row(img_o, img_st).alias("rows"), update.alias("stmt"))
    k3 = o.where(key % 17 == 0).select(
        "key", F.lit(3).alias("kind"), F.lit("EXT_DELETE_ROWS").alias("etype"),
        (F.col("base_ms") + F.lit(60 * DAY_MS)).alias("ts"),
        _one_row(img_st, F.lit(None)).alias("rows"), delete.alias("stmt"))
    ch = k1.unionByName(k2).unionByName(k3)
    m = F.expr("key div 3")
    fileno = F.expr(f"key div 3 div {ORDERS_PER_FILE}")
    return ch.select(
        (key % 3 + 1).alias("server_id"),
        F.concat(F.lit("mysql-bin."), _file_number(fileno + 8)).alias("binarylog"),
        (m * 3 + F.col("kind")).alias("cseq"),
        (m * 3 + F.col("kind")).alias("txn"),
        (fileno * ORDERS_PER_FILE * 3).alias("file_base"),
        "ts", "etype", "stmt", "rows", "key", "kind",
        F.lit(ORDERS_TABLE_ID).alias("table_id"),
        F.lit("shop").alias("db"),
        F.lit("orders").alias("tbl"),
        F.array(*[F.lit(c) for c in ORDERS_COLUMNS]).alias("column_names"),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expand_changes(orders_changes(spark, sf_dir))


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server 4, table shop.customer: insert every customer, then raise the
    balance of every 5th one by one unit (100 cents)."""
    c = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("seg"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("bal"),
    )
    key = F.col("key")
    k = _s(key)
    img = F.array(k, cell_literal("name"), _s("bal"), cell_literal("seg"))
    img2 = F.array(k, cell_literal("name"), _s(F.col("bal") + 100), cell_literal("seg"))
    ins = F.concat(
        F.lit("INSERT INTO customer (c_custkey, c_name, balance_cents, c_mktsegment) VALUES ("),
        k, F.lit(", '"), F.col("name"), F.lit("', "), _s("bal"), F.lit(", '"), F.col("seg"), F.lit("')"),
    )
    upd = F.concat(F.lit("UPDATE customer SET balance_cents = balance_cents + 100 WHERE c_custkey = "), k)
    k1 = c.select("key", F.lit(1).alias("kind"), F.lit("EXT_WRITE_ROWS").alias("etype"),
                  _one_row(F.lit(None), img).alias("rows"), ins.alias("stmt"))
    k2 = c.where(key % 5 == 0).select("key", F.lit(2).alias("kind"), F.lit("EXT_UPDATE_ROWS").alias("etype"),
                                     _one_row(img, img2).alias("rows"), upd.alias("stmt"))
    ch = k1.unionByName(k2)
    cseq = key * 2 + F.col("kind")
    fileno = F.expr(f"key div {CUSTOMERS_PER_FILE}")
    ch = ch.select(
        F.lit(4).cast("long").alias("server_id"),
        F.concat(F.lit("cust-bin."), _file_number(fileno + 1)).alias("binarylog"),
        cseq.alias("cseq"),
        cseq.alias("txn"),
        (fileno * CUSTOMERS_PER_FILE * 2).alias("file_base"),
        (F.lit(CUSTOMER_EPOCH_MS) + cseq * 60_000).alias("ts"),
        "etype", "stmt", "rows",
        F.lit(CUSTOMER_TABLE_ID).alias("table_id"),
        F.lit("shop").alias("db"),
        F.lit("customer").alias("tbl"),
        F.array(*[F.lit(x) for x in CUSTOMER_COLUMNS]).alias("column_names"),
    )
    return _expand_changes(ch)


def accounts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server 6, tables `shop.acct book` (even keys) and `shop.acct_book`: names
    that fold to one folder name, decimals with scale, nulls, a dotted column
    and keys that change. Every customer: insert; update of amount (100.00 to
    75.00 for every third), null and boolean; every fifth moves to another id
    and is updated there."""
    c = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.format_string("%.2f", F.col("c_acctbal").cast("double")).alias("bal"))
    key = F.col("key")
    third, k, moved = key % 3 == 0, _s(key), _s(key + ACCOUNT_MOVE)
    first = F.when(third, F.lit("100.00")).otherwise(F.col("bal"))
    second = F.when(third, F.lit("75.00")).otherwise(F.lit("1.10"))
    null = F.lit(None).cast("string")
    v1 = F.array(k, first, null, F.lit("true"))
    v2 = F.array(k, second, F.lit('"dock"'), F.lit("false"))
    v3 = F.array(moved, second, F.lit('"dock"'), F.lit("false"))
    v4 = F.array(moved, F.lit("0.50"), F.lit('"dock"'), F.lit("false"))
    tbl = F.when(key % 2 == 0, F.lit("acct book")).otherwise(F.lit("acct_book"))
    name = F.concat(F.lit("`"), tbl, F.lit("`"))
    update = F.concat(F.lit("UPDATE "), name, F.lit(" SET amount = "))
    steps = [
        (F.lit(True), "EXT_WRITE_ROWS", _one_row(F.lit(None), v1), F.concat(F.lit("INSERT INTO "), name, F.lit(" VALUES ("), k, F.lit(", "), first, F.lit(", 'none', 1)"))),
        (F.lit(True), "EXT_UPDATE_ROWS", _one_row(v1, v2), F.concat(update, second, F.lit(", `ship.to` = 'dock' WHERE id = "), k)),
        (key % 5 == 0, "EXT_UPDATE_ROWS", _one_row(v2, v3), F.concat(F.lit("UPDATE "), name, F.lit(" SET id = "), moved, F.lit(" WHERE id = "), k)),
        (key % 5 == 0, "EXT_UPDATE_ROWS", _one_row(v3, v4), F.concat(update, F.lit("0.50 WHERE id = "), moved)),
    ]
    ch = None
    for i, (when, etype, rows, stmt) in enumerate(steps):
        one = c.where(when).select("key", tbl.alias("tbl"), F.lit(i).alias("kind"), F.lit(etype).alias("etype"), rows.alias("rows"), stmt.alias("stmt"))
        ch = one if ch is None else ch.unionByName(one)
    fileno = F.expr(f"key div {CUSTOMERS_PER_FILE}")
    cseq = key * len(steps) + F.col("kind")
    ch = ch.select(
        F.lit(6).cast("long").alias("server_id"),
        F.concat(F.lit("acct-bin."), _file_number(fileno + 1)).alias("binarylog"),
        cseq.alias("cseq"), cseq.alias("txn"),
        (fileno * CUSTOMERS_PER_FILE * len(steps)).alias("file_base"),
        (F.lit(CUSTOMER_EPOCH_MS) + cseq * 60_000).alias("ts"),
        "etype", "stmt", "rows",
        (F.lit(ACCOUNT_TABLE_ID) + key % 2).alias("table_id"),
        F.lit("shop").alias("db"), "tbl",
        F.array(*[F.lit(x) for x in ACCOUNT_COLUMNS]).alias("column_names"),
    )
    return _expand_changes(ch)


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server 5, table shop.lineitem: one multi-row WRITE event per order,
    holding all its lines in a total order."""
    li = _read(spark, sf_dir, "lineitem")
    order_cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    w = Window.partitionBy("l_orderkey").orderBy(*order_cols)
    after = F.array(
        _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
        _s(F.col("l_quantity").cast("long")), _s(F.round(F.col("l_extendedprice") * 100).cast("long")),
        cell_literal("l_returnflag"), cell_literal("l_linestatus"),
    )
    r = li.select("l_orderkey", *order_cols, F.row_number().over(w).alias("rn"))  # dealt as typed values
    r = r.select("l_orderkey", "l_shipdate", after.alias("after"), "rn")
    ev = r.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("rn", "after"))).alias("_rows"),
        F.min("l_shipdate").alias("_ship"),
    )
    rows = F.transform("_rows", lambda x: F.struct(F.lit(None).cast("array<string>").alias("before"), x["after"].alias("after")))
    stmt = F.concat(
        F.lit("INSERT INTO lineitem VALUES "),
        F.array_join(F.transform("_rows", lambda x: F.concat(F.lit("("), F.array_join(x["after"], ", "), F.lit(")"))), ", "),
    )
    cseq = F.col("l_orderkey")
    fileno = F.expr(f"l_orderkey div {LINE_ORDERS_PER_FILE}")
    ch = ev.select(
        F.lit(5).cast("long").alias("server_id"),
        F.concat(F.lit("line-bin."), _file_number(fileno + 1)).alias("binarylog"),
        cseq.alias("cseq"),
        cseq.alias("txn"),
        (fileno * LINE_ORDERS_PER_FILE).alias("file_base"),
        epoch_millis("_ship").alias("ts"),
        F.lit("EXT_WRITE_ROWS").alias("etype"),
        stmt.alias("stmt"),
        rows.alias("rows"),
        F.lit(LINEITEM_TABLE_ID).alias("table_id"),
        F.lit("shop").alias("db"),
        F.lit("lineitem").alias("tbl"),
        F.array(*[F.lit(x) for x in LINEITEM_COLUMNS]).alias("column_names"),
    )
    return _expand_changes(ch, with_begin=False)


def control_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-type stream from `events`: each event becomes one log event, so
    GTIDs, XIDs, table maps and SQL text interleave irregularly (row events
    without a map, maps replaced inside a transaction, rows after an XID).

    Files: mysql-bin.<user_id % 4> on server user_id % 2 + 1. Per file a
    FORMAT_DESCRIPTION and PREVIOUS_GTIDS open the file (mysql-bin.3 has no
    PREVIOUS_GTIDS) and a ROTATE closes it (mysql-bin.2 is the active file)."""
    e = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid, uid = F.col("event_id"), F.col("user_id")
    et = F.col("event_type")
    row_type = F.element_at(
        F.array(F.lit("EXT_WRITE_ROWS"), F.lit("EXT_UPDATE_ROWS"), F.lit("EXT_DELETE_ROWS")),
        (eid % 3 + 1).cast("int"),
    )
    etype = (
        F.when(et == "signup", F.lit("GTID"))
        .when(et == "view", F.lit("TABLE_MAP"))
        .when(et == "click", F.lit("ROWS_QUERY"))
        .when(et == "error", F.lit("XID"))
        .when(et == "purchase", row_type)
    )
    server = uid % 2 + 1
    cents = F.round(F.col("value") * 100).cast("long")
    img = F.array(_s(eid), _s(uid), _s(cents))
    img2 = F.array(_s(eid), _s(uid), _s(cents + uid % 3))
    rows = (
        F.when(etype == "EXT_WRITE_ROWS", _one_row(F.lit(None), img))
        .when(etype == "EXT_UPDATE_ROWS", _one_row(img, img2))
        .when(etype == "EXT_DELETE_ROWS", _one_row(img, F.lit(None)))
    )
    is_map = etype == "TABLE_MAP"
    has_table = is_map | etype.startswith("EXT_")
    body = e.select(
        server.alias("server_id"),
        F.concat(F.lit("mysql-bin."), _s(uid % 4)).alias("binarylog"),
        eid.alias("seq"),
        (F.lit(1104) + eid * 100).alias("next_position"),
        etype.alias("event_type"),
        epoch_millis("ts").alias("timestamp"),
        F.when(etype == "GTID", F.concat(_uuid(server), F.lit(":"), _s(eid))).alias("gtid"),
        F.when(etype == "ROWS_QUERY", F.concat(F.lit("UPDATE t SET v = "), _s(eid), F.lit(" WHERE id = "), _s(uid))).alias("query"),
        F.when(has_table, uid % 5).alias("table_id"),
        F.when(is_map, F.lit("shop")).alias("db"),
        F.when(is_map, F.concat(F.lit("t"), _s(uid % 5), F.lit("_v"), _s(eid % 3))).alias("tbl"),
        F.when(is_map, F.array(*[F.lit(c) for c in CONTROL_COLUMNS])).alias("column_names"),
        rows.alias("rows"),
    )
    files = e.groupBy((uid % 4).alias("f")).agg(
        F.min(epoch_millis("ts")).alias("t0"), F.max(epoch_millis("ts")).alias("t1"), F.max(eid).alias("last")
    )
    fsrv = F.col("f") % 2 + 1
    flog = F.concat(F.lit("mysql-bin."), _s("f"))
    fd = files.select(fsrv.alias("server_id"), flog.alias("binarylog"), F.lit(-2).alias("seq"),
                      F.lit(126).alias("next_position"), F.lit("FORMAT_DESCRIPTION").alias("event_type"),
                      F.col("t0").alias("timestamp"))
    pg = files.where(F.col("f") != 3).select(
        fsrv.alias("server_id"), flog.alias("binarylog"), F.lit(-1).alias("seq"),
        F.lit(197).alias("next_position"), F.lit("PREVIOUS_GTIDS").alias("event_type"),
        F.col("t0").alias("timestamp"),
        F.concat(_uuid(fsrv), F.lit(":1-"), _s(F.col("f") + 100)).alias("previous_gtids"))
    rot = files.where(F.col("f") != 2).select(
        fsrv.alias("server_id"), flog.alias("binarylog"), (F.col("last") + 1).alias("seq"),
        F.lit(4).alias("next_position"), F.lit("ROTATE").alias("event_type"),
        F.col("t1").alias("timestamp"),
        F.concat(F.lit("mysql-bin."), _s(F.col("f") + 4)).alias("next_binlog"))
    return _conform(body).unionByName(_conform(fd)).unionByName(_conform(pg)).unionByName(_conform(rot))


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customer logs together (two tables, four servers)."""
    return orders_log(spark, sf_dir).unionByName(customer_log(spark, sf_dir))


def framed(raw: DataFrame) -> DataFrame:
    """Logs as a server closes them: a FORMAT_DESCRIPTION before the first
    event, a ROTATE after the last one, events numbered densely."""
    ends = raw.groupBy(*FILE).agg(
        F.min("seq").alias("first"), F.max("seq").alias("last"), F.max("next_position").alias("end"),
        F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"))
    opens = ends.select(*FILE, (F.col("first") - 1).alias("seq"), F.lit(4).alias("next_position"),
                        F.lit("FORMAT_DESCRIPTION").alias("event_type"), F.col("t0").alias("timestamp"))
    closes = ends.select(*FILE, (F.col("last") + 1).alias("seq"), (F.col("end") + 50).alias("next_position"),
                         F.lit("ROTATE").alias("event_type"), F.col("t1").alias("timestamp"))
    every = raw.unionByName(_conform(opens)).unionByName(_conform(closes))
    return every.withColumn("seq", F.row_number().over(Window.partitionBy(*FILE).orderBy("seq")).cast("long"))
