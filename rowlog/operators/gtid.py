"""GTID set algebra: merge transaction numbers to set text, parse set text
back to intervals, and cut a change stream at a snapshot's executed set."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowlog.functions.text import gtid_txn, gtid_uuid, parse_long

DEFAULT_TXN_BUCKET = 1 << 20
_UNB, _CUR = Window.unboundedPreceding, Window.currentRow


def gtid_runs(df: DataFrame, by, gtid_col: str = "gtid", bucket: int = DEFAULT_TXN_BUCKET) -> DataFrame:
    """Runs of consecutive transaction numbers per (by.., uuid): (lo, hi).

    Sorted numbers merge while each is the previous + 1; a repeated number
    starts a new run (5,5,6 -> 5 and 5-6). Two passes keep every sort small:
    runs inside txn-number buckets (a repeated number always lands in one
    bucket), then runs across bucket edges. Only a bucket's first and last
    run can touch another bucket, so the second pass sorts two rows a bucket,
    however fragmented a hot server's numbers are.
    """
    by = list(by)
    g = df.select(*by, gtid_uuid(gtid_col).alias("uuid"), gtid_txn(gtid_col).alias("txn")).where(
        F.col("txn").isNotNull()
    )
    g = g.withColumn("_b", F.expr(f"txn div {bucket}"))
    w = Window.partitionBy(*by, "uuid", "_b").orderBy("txn")
    brk = F.coalesce(F.col("txn") != F.lag("txn").over(w) + 1, F.lit(True)).cast("long")
    g = g.withColumn("_brk", brk).withColumn("_isl", F.sum("_brk").over(w.rowsBetween(_UNB, _CUR)))
    local = g.groupBy(*by, "uuid", "_b", "_isl").agg(F.min("txn").alias("lo"), F.max("txn").alias("hi"))
    wb = Window.partitionBy(*by, "uuid", "_b").orderBy("lo", "hi")
    edge = F.lag("lo").over(wb).isNull() | F.lead("lo").over(wb).isNull()
    local = local.withColumn("_edge", edge)
    w2 = Window.partitionBy(*by, "uuid").orderBy("lo", "hi")
    # Two edge runs of one bucket never join: numbers repeat between them.
    apart = (F.col("lo") != F.lag("hi").over(w2) + 1) | (F.col("_b") == F.lag("_b").over(w2))
    brk2 = F.coalesce(apart, F.lit(True)).cast("long")
    r = local.where("_edge").withColumn("_brk", brk2).withColumn("_isl", F.sum("_brk").over(w2.rowsBetween(_UNB, _CUR)))
    joined = r.groupBy(*by, "uuid", "_isl").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_isl")
    return joined.unionByName(local.where("not _edge").select(*by, "uuid", "lo", "hi"))


def runs_to_text(runs: DataFrame, by, out: str = "merged_gtids") -> DataFrame:
    """`uuid:a-b:c,uuid2:d` per group; uuids and runs sorted."""
    by = list(by)
    rng = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(
        F.concat(F.col("lo").cast("string"), F.lit("-"), F.col("hi").cast("string"))
    )
    per_uuid = runs.groupBy(*by, "uuid").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", rng.alias("t")))).alias("_r")
    )
    per_uuid = per_uuid.select(
        *by, F.concat(F.col("uuid"), F.lit(":"), F.array_join(F.transform("_r", lambda x: x["t"]), ":")).alias("_s")
    )
    return per_uuid.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("_s")), ",").alias(out))


def merge_gtids(events: DataFrame, by=("server_id", "binarylog"), gtid_col: str = "gtid") -> DataFrame:
    """Merged GTID set text per group, from the GTID events (DDL included).
    Groups without GTID events do not appear; callers left-join and use ''."""
    g = events.where(F.col("event_type") == "GTID") if "event_type" in events.columns else events
    return runs_to_text(gtid_runs(g, by, gtid_col), by)


def gtid_intervals(df: DataFrame, text_col: str, keep=()) -> DataFrame:
    """Set text -> one row per interval (uuid, lo, hi). Blanks around parts
    (servers print a newline after each comma) are ignored."""
    keep = list(keep)
    parts = df.select(*keep, F.explode(F.split(F.col(text_col), ",")).alias("_p"))
    parts = parts.select(*keep, F.trim(F.regexp_replace("_p", r"\s+", "")).alias("_p")).where(F.col("_p") != "")
    sp = F.split("_p", ":")
    rows = parts.select(
        *keep,
        F.element_at(sp, 1).alias("uuid"),
        F.explode(F.slice(sp, 2, F.greatest(F.size(sp) - 1, F.lit(0)))).alias("_r"),
    )
    lohi = F.split("_r", "-")
    lo = parse_long(F.element_at(lohi, 1))
    hi = F.coalesce(parse_long(F.try_element_at(lohi, F.lit(2))), lo)
    return rows.select(*keep, "uuid", lo.alias("lo"), hi.alias("hi"))


def intervals_of(spark: SparkSession, gtid_set: str) -> DataFrame:
    """Intervals of a literal set text (its size is bounded by the text)."""
    return gtid_intervals(spark.createDataFrame([(gtid_set,)], "s string"), "s")


# An interval is repeated in each bucket that it touches. Wide ones use
# buckets WIDER times as large, so none is repeated more than that.
WIDER = 1 << 14
LEVELS = 4


def _bucketed(intervals: DataFrame, bucket: int, level: int) -> DataFrame:
    """The intervals of one level, keyed by (uuid, txn bucket of that level)."""
    size = bucket * WIDER ** level
    span = F.expr(f"hi div {bucket} - lo div {bucket}")
    mine = span >= WIDER ** level if level else F.lit(True)
    if level < LEVELS - 1:
        mine = mine & (span < WIDER ** (level + 1))
    b = F.explode(F.sequence(F.expr(f"lo div {size}"), F.expr(f"hi div {size}"))).alias("_ib")
    kept = intervals.where(F.col("lo").isNotNull() & (F.col("hi") >= F.col("lo"))).where(mine)
    return kept.select(F.col("uuid").alias("_u"), b, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))


def _gtid_set_join(changes: DataFrame, intervals: DataFrame, how: str, bucket: int, level: int) -> DataFrame:
    iv = _bucketed(intervals, bucket, level)
    cb = changes.withColumn("_cb", F.expr(f"gtid_txn div {bucket * WIDER ** level}"))
    cond = (
        (F.col("gtid_uuid") == F.col("_u"))
        & (F.col("_cb") == F.col("_ib"))
        & F.col("gtid_txn").between(F.col("_lo"), F.col("_hi"))
    )
    return cb.join(iv, cond, how).drop("_cb")


def _levels(bucket: int) -> range:
    """Levels whose buckets a 63-bit number can outgrow."""
    return range(next((n for n in range(LEVELS) if bucket * WIDER ** (n + 1) >= 1 << 63), LEVELS - 1) + 1)


def after_gtid_set(changes: DataFrame, intervals: DataFrame, bucket: int = DEFAULT_TXN_BUCKET) -> DataFrame:
    """Changes whose GTID is not in the executed set (`intervals`: uuid, lo, hi).

    Rows without a GTID are kept. The join is an equi-join on (uuid, txn
    bucket) plus the range test, with no broadcast hint: a set parsed from a
    text is tiny and the planner (or AQE at run time) broadcasts it under its
    size threshold; a large set shuffles on a key spread over txn buckets, so
    one busy server uuid does not become one task."""
    for level in _levels(bucket):
        changes = _gtid_set_join(changes, intervals, "left_anti", bucket, level)
    return changes


def in_gtid_set(changes: DataFrame, intervals: DataFrame, bucket: int = DEFAULT_TXN_BUCKET) -> DataFrame:
    """Changes whose GTID is in the executed set (each change at most once)."""
    rest, out = changes, None
    for level in _levels(bucket):
        hit = _gtid_set_join(rest, intervals, "left_semi", bucket, level)
        out = hit if out is None else out.unionByName(hit)
        rest = _gtid_set_join(rest, intervals, "left_anti", bucket, level)
    return out
