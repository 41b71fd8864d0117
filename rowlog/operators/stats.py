"""Conversion statistics: event-type counts, per-table operation counts,
file summary, captured transactions, statement and transaction roll-ups."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.functions.text import op_class, table_key
from rowlog.functions.time import utc_millis
from rowlog.operators.gtid import merge_gtids
from rowlog.schema import FILE, ROW_EVENT_TYPES


def event_type_counts(raw: DataFrame) -> DataFrame:
    """Per event type: `events` (log events), `rows` (exported rows) and
    `reference_count` = events + rows, the figure the reference reports
    (it counts row types once per event and again per exported row). A row
    event exports a row for each of its row images, so one scan of the events
    counts both; only the images' number is needed."""
    is_row = F.col("event_type").isin(*ROW_EVENT_TYPES)
    rows = F.when(is_row, F.coalesce(F.size("rows"), F.lit(0))).otherwise(0).cast("long")
    counts = raw.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum(rows).alias("rows"))
    return counts.withColumn("reference_count", F.col("events") + F.col("rows")).orderBy(F.desc("reference_count"), "event_type")


def total_events(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.sum("events").cast("long").alias("events"),
        F.sum("rows").cast("long").alias("rows"),
        F.sum("reference_count").cast("long").alias("total_events"),
    )


def table_op_counts(changes: DataFrame) -> DataFrame:
    """writes / updates / deletes / total per sanitized table name."""
    c = changes.where(F.col("event").isNotNull() & F.col("table").isNotNull()).select(
        table_key("table").alias("table_key"), op_class("event").alias("op")
    ).where(F.col("op").isNotNull())
    cnt = lambda o: F.count_if(F.col("op") == o).alias(o + "s")
    g = c.groupBy("table_key").agg(cnt("write"), cnt("update"), cnt("delete"))
    return g.withColumn("total", F.col("writes") + F.col("updates") + F.col("deletes")).orderBy(
        F.desc("total"), "table_key"
    )


def _last(cond, *fields):
    """Value(s) of the last event (by seq) matching cond."""
    return F.max(F.when(cond, F.struct(F.col("seq"), *[F.col(f) for f in fields])))


def file_summary(raw: DataFrame) -> DataFrame:
    """One row per log file: file-level server id (from PREVIOUS_GTIDS, else
    0), previous and merged GTID sets, next log, earliest (last
    FORMAT_DESCRIPTION) and latest (last ROTATE, null if never rotated); and
    the sizes, if the events were scanned with `file_size` or `log_size`."""
    t = F.col("event_type")
    sizes = [c for c in ("file_size", "log_size") if c in raw.columns]
    agg = raw.groupBy(*FILE).agg(
        _last(t == "PREVIOUS_GTIDS", "server_id", "previous_gtids").alias("_pg"),
        _last(t == "ROTATE", "next_binlog", "timestamp").alias("_rot"),
        _last(t == "FORMAT_DESCRIPTION", "timestamp").alias("_fd"),
        *(F.max(c).alias(c) for c in sizes),
    )
    merged = merge_gtids(raw, FILE)
    j = agg.join(merged, list(FILE), "left")
    earliest = F.col("_fd.timestamp")
    latest = F.col("_rot.timestamp")
    return j.select(
        *FILE,
        F.coalesce(F.col("_pg.server_id"), F.lit(0).cast("long")).alias("file_server_id"),
        F.col("_pg.previous_gtids").alias("previous_gtids"),
        F.coalesce("merged_gtids", F.lit("")).alias("merged_gtids"),
        F.col("_rot.next_binlog").alias("next_binlog"),
        earliest.alias("earliest"),
        latest.alias("latest"),
        utc_millis(earliest).alias("earliest_utc"),
        utc_millis(latest).alias("latest_utc"),
        *sizes,
    )


def captured_transactions(seq: DataFrame) -> DataFrame:
    """Per GTID segment: row events captured for the transaction, reported
    only when an XID arrived while it was open (the list keeps growing until
    the next GTID, so row events after the XID count too)."""
    t = F.col("event_type")
    g = seq.where(F.col("segment") >= 1).groupBy(*FILE, "segment").agg(
        _last(t == "GTID", "gtid", "position").alias("_g"),
        F.count_if(t.isin(*ROW_EVENT_TYPES)).alias("row_events"),
        (F.count_if(t == "XID") > 0).alias("committed"),
    )
    return g.select(
        *FILE,
        "segment",
        F.col("_g.gtid").alias("gtid"),
        F.col("_g.position").cast("string").alias("gtid_position"),
        "committed",
        F.when(F.col("committed"), F.col("row_events")).alias("captured_events"),
    )


def statements(changes: DataFrame) -> DataFrame:
    """One row per source row event (statement part): rows, SQL, tables."""
    return changes.groupBy(*FILE, "position").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.first("query", ignorenulls=True).alias("query"),
        F.array_join(F.array_sort(F.collect_set("table")), ",").alias("tables"),
        F.min("event").alias("event"),
    )


def txn_rollup(changes: DataFrame) -> DataFrame:
    """One row per transaction (GTID offset): rows, time span, tables."""
    return changes.where(F.col("gtid_position").isNotNull()).groupBy(*FILE, "gtid_position").agg(
        F.first("gtid", ignorenulls=True).alias("gtid"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.array_join(F.array_sort(F.collect_set("table")), ",").alias("tables"),
    )
