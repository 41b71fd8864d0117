"""Workload analytics on the change table: shape detection, write rates,
delete storms, silent tables, co-changed rows, audit candidates, value
transitions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowlog.functions.fingerprint import fingerprint, query_hash
from rowlog.functions.images import change_col, has_change, image_col, image_has, once, parsed, value_text
from rowlog.functions.text import op_class, padded_seq, table_key
from rowlog.schema import FILE

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def log_order(prefix: str = "") -> list:
    """Total log order within one server: server, padded file seq, file, offset, row."""
    return [
        F.col("server_id"),
        padded_seq("binarylog"),
        F.col("binarylog"),
        F.col("position"),
        F.col("row_idx"),
    ]


def log_order_struct():
    s, p, b, pos, r = log_order()
    return F.struct(s.alias("s"), p.alias("p"), b.alias("b"), pos.alias("pos"), r.alias("r"))


def table_event_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("table", "event").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "table", "event")


def new_query_shapes(changes: DataFrame, since_ms: int | None = None, k: int = 20) -> DataFrame:
    """Shapes by first appearance, newest first (top k is the report)."""
    c = changes.where(F.col("query_hash").isNotNull())
    if since_ms is not None:
        c = c.where(F.col("timestamp") >= F.lit(since_ms))
    g = c.groupBy("query_hash").agg(
        F.min("timestamp").alias("first_seen"), F.count(F.lit(1)).alias("rows_affected")
    )
    return g.orderBy(F.desc("first_seen"), "query_hash").limit(k)


def shape_volume(changes: DataFrame) -> DataFrame:
    """Rows per query shape and table, split by operation, and the shape's
    share of all rows that its table had changed by known statements."""
    op = op_class("event")
    shapes = changes.where(F.col("query_hash").isNotNull()).groupBy("query_hash", "query_fingerprint", "table").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(op == "write").alias("writes"),
        F.count_if(op == "update").alias("updates"),
        F.count_if(op == "delete").alias("deletes"),
    )
    # Shapes are few against rows, so the sum over a table is a small window.
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("table"))
    return shapes.withColumn("write_share", F.round(share, 6))


def with_fingerprint(changes: DataFrame, method: str = "expr", text_col: str = "query") -> DataFrame:
    """Attach `query_fingerprint` and `query_hash` by SQL text.

    method="expr" normalizes on every row as plain column expressions (no
    shuffle). method="distinct" normalizes each distinct text once (the
    distinct is combined map-side) and joins the result back on the text.
    With no hint, the planner or AQE broadcasts the text side under its size
    threshold, and AQE splits a hot statement's partitions otherwise."""
    base = changes.drop("query_fingerprint", "query_hash")
    if method == "expr":
        fp = fingerprint(text_col)
        return base.withColumn("query_fingerprint", fp).withColumn("query_hash", query_hash("query_fingerprint"))
    if method != "distinct":
        raise ValueError(f"unknown method {method!r}")
    texts = base.where(F.col(text_col).isNotNull()).select(text_col).distinct()
    texts = texts.select(text_col, fingerprint(text_col).alias("query_fingerprint"))
    texts = texts.withColumn("query_hash", query_hash("query_fingerprint"))
    return base.join(texts, text_col, "left")


def join_statement_stats(by_hash: DataFrame, stats: DataFrame, hash_col: str = "query_hash") -> DataFrame:
    """Left-join per-shape results to a statement-statistics table by hash."""
    return by_hash.join(stats, hash_col, "left")


def statement_stats(changes: DataFrame) -> DataFrame:
    """Per query hash: statements (row events) and the most rows one touched."""
    per_stmt = changes.where(F.col("query_hash").isNotNull()).groupBy(
        "server_id", "binarylog", "position", "query_hash"
    ).agg(F.count(F.lit(1)).alias("_n"))
    return per_stmt.groupBy("query_hash").agg(
        F.count(F.lit(1)).alias("n_statements"), F.max("_n").alias("max_rows")
    )


def bucket_start(ts_col: str, bucket_ms: int):
    return F.col(ts_col) - F.pmod(F.col(ts_col), F.lit(bucket_ms))


def write_rate(changes: DataFrame, bucket_ms: int = HOUR_MS) -> DataFrame:
    """Rows per (table, operation, time bucket)."""
    return changes.groupBy(
        "table", op_class("event").alias("op"), bucket_start("timestamp", bucket_ms).alias("bucket_start")
    ).agg(F.count(F.lit(1)).alias("n"))


def delete_storms(
    changes: DataFrame, bucket_ms: int = DAY_MS, lookback: int = 7, min_deletes: int = 3, ratio: int = 2
) -> DataFrame:
    """Deletes per (table, bucket) against the trailing `lookback` buckets.

    A storm: at least `min_deletes` deletes and at least `ratio` times the
    trailing average (deletes * lookback >= ratio * trailing sum). Counts are
    aggregated first, so the window only sorts buckets, not rows."""
    d = changes.where(op_class("event") == "delete").groupBy(
        "table", bucket_start("timestamp", bucket_ms).alias("bucket_start")
    ).agg(F.count(F.lit(1)).alias("deletes"))
    w = Window.partitionBy("table").orderBy("bucket_start").rangeBetween(-lookback * bucket_ms, -1)
    d = d.withColumn("trailing_deletes", F.coalesce(F.sum("deletes").over(w), F.lit(0)).cast("long"))
    storm = (F.col("deletes") >= min_deletes) & (F.col("deletes") * lookback >= F.col("trailing_deletes") * ratio)
    return d.withColumn("is_storm", storm)


def silent_tables(catalog: DataFrame, changes: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Tables of `catalog` (column `table`) with no change in [start, end)."""
    active = changes.where((F.col("timestamp") >= start_ms) & (F.col("timestamp") < end_ms)).select("table").distinct()
    return catalog.select("table").distinct().join(active, "table", "left_anti")


def table_catalog(seq_or_raw: DataFrame) -> DataFrame:
    """Tables named by TABLE_MAP events."""
    t = seq_or_raw.where(F.col("event_type") == "TABLE_MAP")
    return t.select(F.concat("db", F.lit("."), "tbl").alias("table")).distinct()


def co_changed(changes: DataFrame, predicate, scope: str = "statement") -> DataFrame:
    """Rows changed by the same statement (row event) or transaction as any
    row matching `predicate`. A row outside any transaction is tied to its
    statement alone."""
    if scope not in ("statement", "transaction"):
        raise ValueError("scope must be 'statement' or 'transaction'")
    alone = F.concat(F.lit("@"), F.col("position").cast("string"))
    unit = alone if scope == "statement" else F.coalesce("gtid_position", alone)
    tied = changes.withColumn("_unit", unit)
    key = [*FILE, "_unit"]
    hits = tied.where(predicate).select(*key).distinct()
    return tied.join(hits, key, "left_semi").select(*changes.columns)


def audit_candidates(changes: DataFrame, audited: DataFrame, min_rows: int) -> DataFrame:
    """High-write tables (>= min_rows changed rows) missing from `audited` (column `table`)."""
    from rowlog.operators.stats import table_op_counts

    counts = table_op_counts(changes).where(F.col("total") >= min_rows)
    aud = audited.select(table_key("table").alias("table_key"))
    return counts.join(aud, "table_key", "left_anti")


def transitions(changes: DataFrame, column: str, old, new) -> DataFrame:
    """UPDATE rows where `column` went from `old` to `new`. Values compare by
    their exact text (`100.00` is not `100.0`); None is JSON null."""
    diff = F.col("changed")

    def hit(v: Column) -> Column:
        def is_value(side: str, value) -> Column:
            return change_col(diff, column, side, v).eqNullSafe(F.lit(value_text(value)))

        return has_change(diff, column, v) & is_value("old", old) & is_value("new", new)

    updates = changes.where(F.col("event") == "EXT_UPDATE_ROWS")
    return updates.where(once(parsed(diff), hit))


def first_set(changes: DataFrame, keys: dict, column: str, value) -> DataFrame:
    """Per key, the first change (log order) that set `column` to `value`, and
    its statement: an insert with that value or an update whose diff has it
    as new value."""
    from rowlog.operators.history import key_columns

    wanted = F.lit(value_text(value))
    # Each image is parsed once; of a change only the one that can show it.
    ins = once(parsed("data"), lambda v: image_has("data", column, v) & image_col("data", column, variant=v).eqNullSafe(wanted))
    upd = once(parsed("changed"), lambda v: has_change("changed", column, v) & change_col("changed", column, "new", v).eqNullSafe(wanted))
    event = F.col("event")
    sets = F.when(event == "EXT_WRITE_ROWS", ins).when(event == "EXT_UPDATE_ROWS", upd)
    c = key_columns(changes.where(sets), keys)
    rec = F.struct(
        log_order_struct().alias("o"), F.col("gtid"), F.col("timestamp"), F.col("binarylog"), F.col("position"), F.col("query")
    )
    g = c.groupBy(*keys).agg(F.min(rec).alias("_f"))
    return g.select(*keys, "_f.gtid", "_f.timestamp", "_f.binarylog", "_f.position", "_f.query")
