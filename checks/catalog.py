"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query takes a fixture log built from the driver tables (checks.fixtures),
converts it and runs one operator family on the result. Column
names match the DuckDB oracle in `oracle.queries`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.functions import images as fi
from rowlog.functions import text as ft
from rowlog.functions import time as ftm
from rowlog.functions.fingerprint import fingerprint
from rowlog.operators import gtid as og
from rowlog.operators import history as oh
from rowlog.operators import protect as op
from rowlog.operators import stats as ost
from rowlog.operators import workload as ow
from rowlog.operators.sequence import resolve_table_maps, with_query_text
from rowlog.plans.convert import build_changes, sequenced
from rowlog.schema import CHANGE_COLUMNS, FILE, ROW_EVENT_TYPES
from checks import fixtures as fx
from rowlog.session import INTERMEDIATE, scratch_path, written
from rowlog.sources.raw import assert_event_types, closed_files, raw_events

LOGS = {
    "orders": fx.orders_log,
    "customer": fx.customer_log,
    "lineitem": fx.lineitem_log,
    "control": fx.control_stream,
    "shop": fx.shop_log,
    "accounts": fx.accounts_log,
}

# Fixed values of the query parameters.
ORDERS_KEYS = {"o_orderkey": "bigint"}
CUSTOMER_KEYS = {"c_custkey": "bigint"}
STATE_AT_MS = 867_628_800_000  # 1997-06-30 00:00:00 UTC
RETAINED_FROM_MS = 852_076_800_000  # 1997-01-01: the log kept from here on
SILENT_FROM_MS, SILENT_TO_MS = 883_612_800_000, 915_148_800_000  # 1998
CUSTOMER_SNAPSHOT_SET = fx.UUID_PREFIX + "4:1-1000"
AUDITED_TABLES = ("shop.customer",)
REDACT_POLICY = {"shop.customer": {"c_name": "hash", "c_mktsegment": "drop"}}
STATE_STEPS_MS = tuple(725_846_400_000 + k * 7 * 2_592_000_000 for k in range(9))  # every 210 days from 1993-01-01
STATE_INSTANTS_MS = (STATE_STEPS_MS[3] + 86_400_000, STATE_STEPS_MS[8], STATE_AT_MS)
LOOKED_UP_ORDER = 17
ACCOUNT_KEYS = {"id": "bigint"}
ACCOUNT_POLICY = {"shop.acct book": {"amount": "hash"}}


_LANDED: dict[tuple[str, str, str], str] = {}


def raw_of(spark: SparkSession, sf: str, log: str) -> DataFrame:
    """The event table of a fixture log: written once for a session, as a
    decoder would land it, then scanned."""
    key = (spark.sparkContext.applicationId, sf, log)
    if key not in _LANDED:
        path = scratch_path(spark, f"events-{log}")
        LOGS[log](spark, sf).write.options(**INTERMEDIATE).parquet(path)
        _LANDED[key] = path
    return raw_events(spark, _LANDED[key])


def lake_of(spark: SparkSession, sf: str, log: str) -> DataFrame:
    """The changes of a fixture log, converted once for a session: what the
    analyses read, as they would read a lake."""
    key = (spark.sparkContext.applicationId, sf, f"{log} changes")
    if key not in _LANDED:
        _LANDED[key] = scratch_path(spark, f"changes-{log}")
        changes_of(spark, sf, log).write.options(**INTERMEDIATE).parquet(_LANDED[key])
    return spark.read.parquet(_LANDED[key])


def changes_of(spark: SparkSession, sf: str, log: str, **kw) -> DataFrame:
    if log == "control":
        kw.setdefault("missing", "null")
    return build_changes(raw_of(spark, sf, log), **kw)


def seq_of(spark, sf, log, **kw):
    return sequenced(raw_of(spark, sf, log), **kw)


def _flat(ch: DataFrame) -> DataFrame:
    cols = [c for c in CHANGE_COLUMNS if c != "timestamp_string"]
    return ch.select(*cols, ftm.utc_millis("timestamp").alias("timestamp_utc"), "row_idx")


# ---- conversion (G1, F12-F16, W6) ------------------------------------------
def row_changes(spark, sf):
    return _flat(changes_of(spark, sf, "orders"))


def row_diff(spark, sf):
    ch = changes_of(spark, sf, "orders", fingerprints=False)
    return ch.where(F.col("event") == "EXT_UPDATE_ROWS").select(
        *FILE, "position", "row_idx", "old", "data", "changed", "columns"
    )


def change_counter(spark, sf):
    ch = changes_of(spark, sf, "orders", fingerprints=False)
    return ch.select(
        *FILE, "position", "row_idx", "counter",
        ft.change_pk("gtid_uuid", "gtid_txn", "server_id", "binarylog", "position", "counter").alias("pk"),
    )


def multi_row_explode(spark, sf):
    ch = changes_of(spark, sf, "lineitem", fingerprints=False)
    return ch.select(*FILE, "position", "row_idx", "gtid", "counter", "data", "columns")


def statements(spark, sf):
    return ost.statements(changes_of(spark, sf, "lineitem"))


def customer_changes(spark, sf):
    return _flat(changes_of(spark, sf, "customer"))


# ---- sequencing on the control stream (W1-W5, J1, A7) ----------------------
def event_positions(spark, sf):
    return seq_of(spark, sf, "control").select(*FILE, "seq", "event_type", "position")


def txn_tagging(spark, sf):
    s = seq_of(spark, sf, "control")
    return s.select(*FILE, "seq", "event_type", F.col("txn_gtid").alias("gtid"), F.col("txn_position").alias("gtid_position"))


def txn_segments(spark, sf):
    return seq_of(spark, sf, "control").select(*FILE, "seq", "segment")


def stale_query_carry(spark, sf):
    raw = raw_of(spark, sf, "control")
    s = with_query_text(sequenced(raw), raw)
    return s.where(F.col("event_type").isin(*ROW_EVENT_TYPES)).select(*FILE, "seq", F.col("last_query").alias("query"))


def query_txn_scope(spark, sf):
    raw = raw_of(spark, sf, "control")
    s = with_query_text(sequenced(raw, query_scope="txn"), raw)
    return s.where(F.col("event_type").isin(*ROW_EVENT_TYPES)).select(*FILE, "seq", F.col("last_query").alias("query"))


def table_map_resolution(spark, sf):
    raw = raw_of(spark, sf, "control")
    t = resolve_table_maps(sequenced(raw), raw, missing="null")
    return t.select(*FILE, "seq", "segment", "table_id", ft.qualified_table("db", "tbl").alias("table"),
                    F.to_json("column_names").alias("column_names"))


def control_changes(spark, sf):
    return _flat(changes_of(spark, sf, "control"))


def captured_transactions(spark, sf):
    return ost.captured_transactions(seq_of(spark, sf, "control"))


# ---- statistics (A1-A6, O2, O3) ---------------------------------------------
def file_summary(spark, sf):
    return ost.file_summary(raw_of(spark, sf, "control"))


def merge_gtids(spark, sf):
    return og.merge_gtids(raw_of(spark, sf, "orders"), FILE)


def merge_gtids_fragmented(spark, sf):
    """Every third number is missing, so runs grow with the data; small buckets."""
    raw = raw_of(spark, sf, "orders").where((F.col("event_type") == "GTID") & (ft.gtid_txn("gtid") % 3 != 0))
    return og.runs_to_text(og.gtid_runs(raw, FILE, bucket=64), FILE)


def gtid_intervals(spark, sf):
    m = og.merge_gtids(raw_of(spark, sf, "orders"), FILE)
    return og.gtid_intervals(m, "merged_gtids", keep=FILE)


def event_type_counts(spark, sf):
    raw = raw_of(spark, sf, "shop")
    return ost.event_type_counts(raw)


def total_events(spark, sf):
    raw = raw_of(spark, sf, "shop")
    return ost.total_events(ost.event_type_counts(raw))


def table_op_counts(spark, sf):
    return ost.table_op_counts(lake_of(spark, sf, "shop"))


def table_event_counts(spark, sf):
    return ow.table_event_counts(lake_of(spark, sf, "shop"))


def txn_rollup(spark, sf):
    return ost.txn_rollup(lake_of(spark, sf, "shop"))


# ---- fingerprints and shapes (F21, F22, J2, A9, A10, L3) --------------------
def query_fingerprint(spark, sf):
    ch = lake_of(spark, sf, "shop")
    return ch.groupBy("query_fingerprint", "query_hash").agg(F.count(F.lit(1)).alias("n_rows"))


def new_query_shapes(spark, sf):
    return ow.new_query_shapes(lake_of(spark, sf, "shop"))


def shape_volume(spark, sf):
    return ow.shape_volume(lake_of(spark, sf, "shop"))


def statement_stats_join(spark, sf):
    """J2 (distinct-text form) and J3: per-shape rows joined to statement stats."""
    ch = ow.with_fingerprint(lake_of(spark, sf, "shop"), method="distinct")
    by_hash = ch.where(F.col("query_hash").isNotNull()).groupBy("query_hash", "query_fingerprint").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return ow.join_statement_stats(by_hash, ow.statement_stats(ch))


# ---- time travel (H1-H4, W7, W8, L4, J4) ------------------------------------
def _orders(spark, sf):
    return lake_of(spark, sf, "orders")


def state_at(spark, sf):
    return oh.state_at(_orders(spark, sf), ORDERS_KEYS, STATE_AT_MS)


def state_at_preimage(spark, sf):
    ch = _orders(spark, sf).where(F.col("timestamp") >= RETAINED_FROM_MS)
    return oh.state_at(ch, ORDERS_KEYS, STATE_AT_MS, use_preimage=True)


def row_history(spark, sf):
    return oh.row_history(_orders(spark, sf), ORDERS_KEYS)


def first_set(spark, sf):
    return ow.first_set(_orders(spark, sf), ORDERS_KEYS, "o_orderstatus", "F")


def _accounts(spark, sf, **kw):
    return changes_of(spark, sf, "accounts", fingerprints=False, **kw) if kw else lake_of(spark, sf, "accounts")


def _moved(spark, sf, column, old, new):
    t = ow.transitions(_accounts(spark, sf), column, old, new)
    return t.select(*FILE, "gtid", "table", fi.image_col("data", "id", "bigint").alias("id"), fi.image_col("data", "amount").alias("amount"))


def transitions_decimal(spark, sf):
    return _moved(spark, sf, "amount", "100.00", "75.00")


def transitions_null(spark, sf):
    return _moved(spark, sf, "ship.to", None, "dock").unionByName(_moved(spark, sf, "active", True, False))


def row_history_moves(spark, sf):
    return oh.row_history(_accounts(spark, sf), ACCOUNT_KEYS)


def transitions(spark, sf):
    t = ow.transitions(_orders(spark, sf), "o_orderstatus", "O", "F")
    return t.select(*FILE, "position", "gtid", fi.image_col("data", "o_orderkey", "bigint").alias("o_orderkey"))


def after_gtid_set(spark, sf):
    ch = lake_of(spark, sf, "customer")
    later = og.after_gtid_set(ch, og.intervals_of(spark, CUSTOMER_SNAPSHOT_SET))
    return later.select(*FILE, "position", "gtid", "event")


def bootstrap(spark, sf):
    ch = lake_of(spark, sf, "customer")
    iv = og.intervals_of(spark, CUSTOMER_SNAPSHOT_SET)
    inside = og.in_gtid_set(ch, iv)
    snapshot = oh.state_at(inside, CUSTOMER_KEYS, 1 << 62)
    return oh.bootstrap(snapshot, ch, iv, CUSTOMER_KEYS)


# ---- workload (A11-A14, J5, J6) --------------------------------------------
def _shop(spark, sf):
    return lake_of(spark, sf, "shop")


def write_rate(spark, sf):
    return ow.write_rate(_shop(spark, sf), ow.HOUR_MS)


def delete_storms(spark, sf):
    return ow.delete_storms(_shop(spark, sf), ow.DAY_MS, lookback=7, min_deletes=3, ratio=2)


def silent_tables(spark, sf):
    raw = raw_of(spark, sf, "shop").unionByName(raw_of(spark, sf, "lineitem"))
    ch = build_changes(raw, fingerprints=False)
    return ow.silent_tables(ow.table_catalog(raw), ch, SILENT_FROM_MS, SILENT_TO_MS)


def co_changed(spark, sf):
    ch = changes_of(spark, sf, "lineitem", fingerprints=False)
    hit = F.get_json_object("data", "$.l_returnflag") == "R"
    return ow.co_changed(ch, hit, "statement").select(*FILE, "position", "row_idx")


def co_changed_txn(spark, sf):
    ch = changes_of(spark, sf, "control", fingerprints=False)
    return ow.co_changed(ch, F.col("event") == "EXT_DELETE_ROWS", "transaction").select(*FILE, "position", "row_idx")


def audit_candidates(spark, sf):
    raw = raw_of(spark, sf, "shop").unionByName(raw_of(spark, sf, "lineitem"))
    ch = build_changes(raw, fingerprints=False)
    audited = spark.createDataFrame([(t,) for t in AUDITED_TABLES], "table string")
    return ow.audit_candidates(ch, audited, min_rows=100)


# ---- scalar functions on driver-derived text (F1-F11) -----------------------
def _variants(spark, sf, texts):
    e = fx._read(spark, sf, "events").select("event_id")
    arr = F.array(*texts)
    return e.select("event_id", F.element_at(arr, (F.col("event_id") % len(texts) + 1).cast("int")).alias("t"))


def gtid_parse(spark, sf):
    i = F.col("event_id").cast("string")
    v = _variants(spark, sf, [
        F.concat(F.lit("u"), i, F.lit(":"), i), F.concat(F.lit("u"), i, F.lit(":")), F.concat(F.lit(":"), i),
        F.concat(F.lit("u"), i), F.lit(""), F.concat(F.lit("u:"), i, F.lit(":2")), F.concat(F.lit("u: "), i),
        F.concat(F.lit("u:+"), i), F.concat(F.lit("u:99999999999999999999"), i), F.lit(None).cast("string"),
    ])
    return v.select("event_id", F.col("t").alias("gtid"), ft.gtid_uuid("t").alias("gtid_uuid"),
                    ft.gtid_txn_text("t").alias("txn_text"), ft.gtid_txn("t").alias("gtid_txn"))


def fingerprint_cases(spark, sf):
    """Statements that a rewrite by one rule after another gets wrong."""
    i = F.col("event_id").cast("string")
    v = _variants(spark, sf, [
        F.concat(F.lit("INSERT INTO t VALUES ('/*', 'x"), i, F.lit("', '*/')")),
        F.concat(F.lit("UPDATE t SET a = "), i, F.lit("--3 WHERE id = "), i),
        F.concat(F.lit("UPDATE t SET a = 1 -- don't\n, b = 'x' WHERE id = "), i),
        F.concat(F.lit("UPDATE `it's` SET a = 'q"), i, F.lit("'")),
        F.concat(F.lit("UPDATE t SET a = ."), i, F.lit(" WHERE b = 1.5e-3")),
        F.concat(F.lit("INSERT INTO t VALUES "), F.array_join(F.array_repeat(F.concat(F.lit("("), i, F.lit(", 'v', -1)")), 300), ", ")),
        F.concat(F.lit("UPDATE t SET a = '"), F.repeat(F.lit("''"), 500), i, F.lit("' WHERE id IN (1, 2)")),
    ])
    return v.select("event_id", fingerprint("t").alias("query_fingerprint"))


def padded_names(spark, sf):
    i = F.col("event_id").cast("string")
    v = _variants(spark, sf, [
        F.concat(F.lit("mysql-bin."), i), F.lit("x"), F.lit("x."), F.concat(F.lit("a.b.0000"), i),
        F.concat(F.lit("m."), i, F.lit("00000000000")), F.concat(i, F.lit("-basic-crud.binlog")),
        F.concat(F.lit("n.-"), i),
    ])
    return v.select("event_id", F.col("t").alias("name"), ft.padded_seq("t").alias("log_seq"),
                    ft.output_name("t", F.col("event_id") % 3 + 1).alias("output_name"))


def table_keys(spark, sf):
    i = F.col("event_id").cast("string")
    v = _variants(spark, sf, [
        F.concat(F.lit("db.t"), i), F.concat(F.lit("a b.c/d"), i), F.lit(""), F.lit(None).cast("string"),
        F.lit("  "), F.concat(F.lit("x\ty"), i), F.concat(F.lit("schéma.t"), i),
    ])
    return v.select("event_id", F.col("t").alias("name"), ft.table_key("t").alias("table_key"),
                    ft.op_class(F.element_at(F.array(F.lit("EXT_WRITE_ROWS"), F.lit("update_rows"), F.lit("DELETE"),
                                                     F.lit("QUERY"), F.lit("insert")),
                                             (F.col("event_id") % 5 + 1).cast("int"))).alias("op"))


def time_formats(spark, sf):
    e = fx._read(spark, sf, "events").select("event_id", ftm.epoch_millis("ts").alias("ms"))
    texts = F.element_at(
        F.array(F.col("ms").cast("string"), ftm.utc_seconds("ms"), F.lit("not a time"), F.concat(F.lit(" "), F.col("ms").cast("string"))),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    return e.select("event_id", "ms", ftm.utc_seconds("ms").alias("utc_seconds"), ftm.utc_millis("ms").alias("utc_millis"),
                    texts.alias("text"), ftm.parse_time_text(texts).alias("parsed_ms"))


def json_images(spark, sf):
    ch = changes_of(spark, sf, "orders", fingerprints=False)
    read = fi.once(fi.parsed("data"), lambda v: F.struct(
        fi.image_col("data", "cents", "bigint", v).alias("cents"),
        fi.image_col("data", "o_orderstatus", variant=v).alias("status"),
        fi.image_has("data", "cents", v).alias("has_cents"),
        fi.image_has("data", "missing", v).alias("has_missing")))
    return ch.select(*FILE, "position", "row_idx", read.alias("x")).select(*FILE, "position", "row_idx", "x.*")


# ---- protection (L5-L7) ----------------------------------------------------
def filtered_tables(spark, sf):
    ch = _shop(spark, sf)
    f = op.filter_tables(ch, allow=[r"shop\..*"], deny=[r".*cust.*"], regex=True)
    return f.groupBy("table", "event").agg(F.count(F.lit(1)).alias("n"))


def redacted_changes(spark, sf):
    ch = changes_of(spark, sf, "customer", fingerprints=False, redact=REDACT_POLICY)
    return ch.select(*FILE, "position", "row_idx", "data", "old", "changed", "columns")


def redacted_query(spark, sf):
    ch = _accounts(spark, sf, redact=ACCOUNT_POLICY)
    return ch.groupBy("table", "query").agg(F.count(F.lit(1)).alias("n"))


def encrypted_roundtrip(spark, sf):
    ch = changes_of(spark, sf, "customer", fingerprints=False).select(*FILE, "position", "row_idx", "data", "old", "changed")
    key = written(spark.range(1).select(F.substring(F.sha2(F.expr("uuid()"), 256), 1, 32).alias("key")), "key")
    enc = written(op.encrypt_images(ch, key.scalar()), "encrypted")
    return op.decrypt_images(enc, key.scalar())


def event_type_gate(spark, sf):
    raw = raw_of(spark, sf, "control")
    odd = (F.col("event_type") == "GTID") & (F.col("seq") % 50 == 0)
    raw = raw.withColumn("event_type", F.when(odd, F.lit("ANONYMOUS_GTID")).otherwise(F.col("event_type")))
    ok, bad = assert_event_types(raw, on_error="quarantine")
    return ok.select("event_type", F.lit(True).alias("accepted")).unionByName(
        bad.select("event_type", F.lit(False).alias("accepted"))
    ).groupBy("event_type", "accepted").agg(F.count(F.lit(1)).alias("n"))


def closed_logs(spark, sf):
    raw = raw_of(spark, sf, "orders")
    listing = raw.select("server_id", "binarylog").distinct()
    current = listing.groupBy("server_id").agg(F.max_by("binarylog", ft.padded_seq("binarylog")).alias("binarylog"))
    return closed_files(listing, current, keys=["server_id"]).select("server_id", "binarylog", "log_seq")


QUERIES = {
    f.__name__: f
    for f in [
        row_changes, row_diff, change_counter, multi_row_explode, statements, customer_changes,
        event_positions, txn_tagging, txn_segments, stale_query_carry, query_txn_scope,
        table_map_resolution, control_changes, captured_transactions,
        file_summary, merge_gtids, gtid_intervals, event_type_counts, total_events,
        table_op_counts, table_event_counts, txn_rollup,
        query_fingerprint, new_query_shapes, shape_volume, statement_stats_join,
        state_at, state_at_preimage, row_history, first_set, transitions, after_gtid_set, bootstrap,
        transitions_decimal, transitions_null, row_history_moves, merge_gtids_fragmented,
        write_rate, delete_storms, silent_tables, co_changed, co_changed_txn, audit_candidates,
        gtid_parse, fingerprint_cases, redacted_query, padded_names, table_keys, time_formats, json_images,
        filtered_tables, redacted_changes, encrypted_roundtrip, event_type_gate, closed_logs,
    ]
}


# ---- sinks and streams (K1-K8, S4, S5, T1-T4) ------------------------------
def _lake(spark, sf, log="shop", by_file=False):
    from rowlog.sinks.parquet import write_by_table

    root = scratch_path(spark, "lake")
    write_by_table(changes_of(spark, sf, log, fingerprints=False), root, by_file=by_file)
    return root


def per_table_roundtrip(spark, sf):
    from rowlog.sinks.parquet import read_lake

    lake = read_lake(spark, _lake(spark, sf))
    return lake.select("table_key", *FILE, "position", "row_idx", "data")


def lake_one_table(spark, sf):
    from rowlog.sinks.parquet import read_lake

    lake = read_lake(spark, _lake(spark, sf, by_file=True), by_file=True, tables=["shop.customer"])
    return lake.select("log_seq", "table_key", *FILE, "position", "row_idx", "changed")


def single_file_roundtrip(spark, sf):
    from rowlog.sinks.parquet import write_single

    path = scratch_path(spark, "single")
    write_single(changes_of(spark, sf, "shop", fingerprints=False), path)
    return spark.read.parquet(path).select(*FILE, "position", "row_idx", "event", "table", "data")


def output_audit(spark, sf):
    from rowlog.sinks.parquet import audit_output, write_by_table

    changes = written(changes_of(spark, sf, "shop", fingerprints=False), "changes")  # once, for the counts and for the lake
    root = scratch_path(spark, "lake")
    write_by_table(changes, root)
    expected = ost.table_op_counts(changes).select(
        "table_key", F.col("total").alias("expected_rows")
    )
    return audit_output(spark, root, expected)


def written_stats(spark, sf):
    from rowlog.sinks.parquet import write_stats

    root = scratch_path(spark, "stats")
    raw = raw_of(spark, sf, "shop")
    ch = build_changes(raw, fingerprints=False)
    write_stats(root, table_op_counts=ost.table_op_counts(ch), file_summary=ost.file_summary(raw))
    return spark.read.parquet(f"{root}/_stats/table_op_counts")


def _landed_events(spark, sf, log, framed=False):
    """Land a fixture log as event-table files, each holding whole log files."""
    src = scratch_path(spark, "events")
    raw = raw_of(spark, sf, log)
    (fx.framed(raw) if framed else raw).repartition(*FILE).write.parquet(src)
    return src


def stream_convert(spark, sf):
    from rowlog.sinks.parquet import read_lake
    from rowlog.streaming.stream import stream_convert as start

    src, dst = _landed_events(spark, sf, "orders", framed=True), scratch_path(spark, "stream-lake")
    q = start(spark, src, dst, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    lake = read_lake(spark, dst, by_file=True)
    return _flat(lake)


def _rewritten_lake(spark, sf, log="shop", **kw):
    """A lake whose logs are written, and again in a second version. Yields the
    lake after each write, for a stream to read it."""
    from rowlog.sinks.parquet import write_by_table

    root, changes = scratch_path(spark, "lake"), written(changes_of(spark, sf, log, **kw), "changes")
    for _ in range(2):
        write_by_table(changes, root, by_file=True)
        yield root


def stream_write_rate(spark, sf):
    from rowlog.streaming.stream import stream_write_rate as start

    out, ckpt = scratch_path(spark, "rate"), scratch_path(spark, "rate-ckpt")
    for lake in _rewritten_lake(spark, sf, fingerprints=False):
        start(spark, lake, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


def stream_query_shapes(spark, sf):
    from rowlog.streaming.stream import stream_query_shapes as start

    out, ckpt = scratch_path(spark, "shapes"), scratch_path(spark, "shapes-ckpt")
    for lake in _rewritten_lake(spark, sf):
        start(spark, lake, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


def _renamed(raw: DataFrame, base: str) -> DataFrame:
    """The same log under another base name: same server, same number."""
    return raw.withColumn("binarylog", F.concat(F.lit(base + "."), F.substring_index("binarylog", ".", -1)))


def _per_log(lake: DataFrame) -> DataFrame:
    return lake.groupBy("log_base", "server_id", "table_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("log_seq").alias("logs"))


def lake_two_bases(spark, sf):
    """Two logs of one server and number in one lake, the second one twice."""
    from rowlog.sinks.parquet import read_lake, write_by_table

    root = scratch_path(spark, "lake")
    raw = raw_of(spark, sf, "customer")
    for base in ("cust-bin", "other-bin", "other-bin"):
        write_by_table(build_changes(_renamed(raw, base), fingerprints=False), root, by_file=True)
    return _per_log(read_lake(spark, root, by_file=True))


def lake_table_exact(spark, sf):
    from rowlog.sinks.parquet import read_lake, write_by_table

    root = scratch_path(spark, "lake")
    write_by_table(_accounts(spark, sf), root, by_file=True)
    one = read_lake(spark, root, by_file=True, tables=["shop.acct book"])
    return one.groupBy("table", "table_key", "event").agg(F.count(F.lit(1)).alias("n"))


def stream_two_batches(spark, sf):
    from rowlog.sinks.parquet import read_lake
    from rowlog.streaming.stream import stream_convert as start

    src, dst, ckpt = (scratch_path(spark, f"two-{x}") for x in ("src", "lake", "ckpt"))
    raw = raw_of(spark, sf, "customer")
    for base in ("cust-bin", "other-bin"):
        fx.framed(_renamed(raw, base)).repartition(*FILE).write.mode("append").parquet(src)
        start(spark, src, dst, ckpt, fingerprints=False).awaitTermination()
    return _per_log(read_lake(spark, dst, by_file=True))


def convert_job(spark, sf):
    """The whole job on a landed event table; every row carries its table's audit."""
    from rowlog.plans.convert import convert
    from rowlog.sinks.parquet import read_lake

    src, dst = _landed_events(spark, sf, "accounts"), scratch_path(spark, "job")
    done = convert(spark, src, dst)
    audit = done.audit.select("table_key", F.col("ok").alias("audit_ok"), F.col("expected_rows").alias("audit_rows"))
    return read_lake(spark, dst, by_file=True).join(audit, "table_key").select(
        *FILE, "position", "row_idx", "table", "event", "data", F.unix_millis("timestamp_string").alias("instant_ms"), "audit_ok", "audit_rows")


def empty_lake(spark, sf):
    """Events without row changes: the lake is empty, readable, and reported."""
    from rowlog.plans.convert import convert
    from rowlog.sinks.parquet import read_lake

    src, dst = scratch_path(spark, "no-rows"), scratch_path(spark, "empty")
    raw_of(spark, sf, "customer").where(~F.col("event_type").isin(*ROW_EVENT_TYPES)).write.parquet(src)
    done = convert(spark, src, dst)
    rows = read_lake(spark, dst, by_file=True).count() + done.audit.count()
    return done.event_type_counts.withColumn("lake_rows", F.lit(rows).cast("long"))


def stream_rate_append(spark, sf):
    """Hourly rates, each once: the second batch rewrites what the first had."""
    from rowlog.sinks.parquet import write_by_table
    from rowlog.streaming.stream import stream_write_rate as start

    lake, out, ckpt = (scratch_path(spark, f"rate-{x}") for x in ("lake", "out", "ckpt"))
    ch = lake_of(spark, sf, "customer")
    half = ch.where(F.col("timestamp") <= ch.select(F.expr("(min(timestamp) + max(timestamp)) div 2").alias("t")).scalar())
    for part in (half, ch):
        write_by_table(part, lake, by_file=True)
        start(spark, lake, out, ckpt, watermark="1 hour", output_mode="append").awaitTermination()
    return spark.read.parquet(out)


def stream_first_seen(spark, sf):
    """One alert a shape, although the second batch has the same rows again."""
    from rowlog.sinks.parquet import write_by_table
    from rowlog.streaming.stream import stream_first_seen as start

    lake, out, ckpt = (scratch_path(spark, f"seen-{x}") for x in ("lake", "out", "ckpt"))
    for log in ("customer", "shop"):
        write_by_table(changes_of(spark, sf, log), lake, by_file=True)
        start(spark, lake, out, ckpt).awaitTermination()
    return spark.read.parquet(out).groupBy("query_hash", "query_fingerprint").agg(F.count(F.lit(1)).alias("alerts"))


def stream_split_log(spark, sf):
    """Logs that land in two pieces, a few events in both: nothing is converted
    before a log is whole, and each change comes once, in its place."""
    from rowlog.sinks.parquet import read_lake
    from rowlog.streaming.stream import stream_convert as start

    src, dst, ckpt = (scratch_path(spark, f"split-{x}") for x in ("src", "lake", "ckpt"))
    raw = written(fx.framed(raw_of(spark, sf, "customer")), "framed")
    ends = raw.groupBy(*FILE).agg((F.max("seq") / 2).cast("long").alias("middle"))
    cut = raw.join(ends, list(FILE))
    for piece in ("seq <= middle + 5", "seq > middle"):
        cut.where(piece).select(*raw.columns).write.mode("append").parquet(src)
        start(spark, src, dst, ckpt).awaitTermination()
    return _flat(read_lake(spark, dst, by_file=True))


def stream_delete_storms(spark, sf):
    """Closed days, each once: the second batch rewrites the logs of the first."""
    from rowlog.sinks.parquet import write_by_table
    from rowlog.streaming.stream import stream_delete_storms as start

    lake, out, ckpt = (scratch_path(spark, f"storms-{x}") for x in ("lake", "out", "ckpt"))
    ch = lake_of(spark, sf, "orders")
    half = ch.where(F.col("timestamp") <= ch.select(F.expr("(min(timestamp) + max(timestamp)) div 2").alias("t")).scalar())
    for part in (half, ch):
        write_by_table(part, lake, by_file=True)
        start(spark, lake, out, ckpt, watermark="1 day").awaitTermination()
    return spark.read.parquet(out)


def lake_versions(spark, sf):
    """The snapshots of a lake whose logs are rewritten: all changes, then inserts only."""
    from rowlog.sinks.parquet import read_lake, write_by_table

    root, ch = scratch_path(spark, "lake"), lake_of(spark, sf, "shop")
    write_by_table(ch, root, by_file=True)
    write_by_table(ch.where("event = 'EXT_WRITE_ROWS' and server_id <> 4"), root, by_file=True)
    each = [read_lake(spark, root, by_file=True, version=v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return each[0].unionByName(each[1]).groupBy("version", "table", "event").agg(F.count(F.lit(1)).alias("n"))


def file_sizes(spark, sf):
    """Logs landed with the size of the original file."""
    src, raw = scratch_path(spark, "sized"), raw_of(spark, sf, "orders")
    sizes = raw.groupBy(*FILE).agg(F.max("next_position").alias("log_size"))
    raw.join(sizes, list(FILE)).write.parquet(src)
    return ost.file_summary(raw_events(spark, src, with_file_size=True, with_log_size=True)).select(*FILE, "log_size")


def empty_row_events(spark, sf):
    """Row events without images give no rows; the lengths of update images are checked."""
    raw = raw_of(spark, sf, "customer")
    empty = F.col("event_type").isin(*ROW_EVENT_TYPES) & (F.expr("timestamp div 60000 % 7") == 0)
    raw = raw.withColumn("rows", F.when(~empty, F.col("rows")).otherwise(F.filter("rows", lambda r: F.lit(False))))
    ch = build_changes(raw, fingerprints=False, strict=True)
    return ch.select(*FILE, "position", "row_idx", "event", "data")


def single_ordered(spark, sf):
    """The place of every change in the one output file."""
    from rowlog.sinks.parquet import write_single

    path = scratch_path(spark, "ordered")
    write_single(lake_of(spark, sf, "shop"), path, files=1)
    return spark.read.parquet(path).select(*FILE, "position", "row_idx", (F.col("_metadata.row_index") + 1).alias("place"))


def typed_images(spark, sf):
    """Images of typed rows: times with their offset, bytes in base64, nulls kept; and single cells."""
    e = fx._read(spark, sf, "events")
    row = F.struct("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").cast("binary").alias("kind"),
                   F.lit(None).cast("string").alias("none"), (F.col("user_id") % 2 == 0).alias("even"))
    return e.select("event_id", fi.typed_image(row).alias("image"), fi.cell_literal("event_type").alias("text"),
                    fi.cell_literal(F.when(F.col("user_id") % 3 != 0, F.col("user_id"))).alias("number"))


def state_at_incremental(spark, sf):
    """The orders at three instants, from segments folded at many instants and the changes after them."""
    from rowlog.operators.statetable import StateTable

    table, ch = StateTable(spark, scratch_path(spark, "state"), ORDERS_KEYS, fanout=3), _orders(spark, sf)
    for t in STATE_STEPS_MS:
        table.advance(ch, t)
    out = None
    for t in STATE_INSTANTS_MS:
        one = table.at(ch, t).withColumn("instant", F.lit(t))
        out = one if out is None else out.unionByName(one)
    return out


def key_lookup(spark, sf):
    """The changes of one order, and of one status, from the files that an index of values leaves."""
    from rowlog.sinks.parquet import write_by_table
    from rowlog.sinks.skipping import index_columns, lookup

    root = scratch_path(spark, "indexed")
    write_by_table(_orders(spark, sf), root, by_file=True)
    index_columns(spark, root, "shop.orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    one = lookup(spark, root, "shop.orders", {"o_orderkey": LOOKED_UP_ORDER})
    some = lookup(spark, root, "shop.orders", {"o_orderstatus": "P", "o_orderpriority": "1-URGENT"})
    return one.unionByName(some).select(*FILE, "position", "row_idx", "event", "data", "old")


QUERIES.update({
    f.__name__: f
    for f in [file_sizes, empty_row_events, single_ordered, typed_images, state_at_incremental, key_lookup, stream_split_log, stream_delete_storms, lake_versions, lake_two_bases, lake_table_exact, stream_two_batches, convert_job, empty_lake, stream_rate_append,
              stream_first_seen, per_table_roundtrip, lake_one_table, single_file_roundtrip, output_audit, written_stats,
              stream_convert, stream_write_rate, stream_query_shapes]
})
