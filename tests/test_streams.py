"""The completeness gate, live counts through rewrites, live delete storms, cleaning of sources."""
import os
import time

import pytest
from helpers import SF, raw_df, txn
from pyspark.sql import functions as F

from checks import fixtures as fx
from rowlog.operators.workload import delete_storms, write_rate
from rowlog.plans.convert import build_changes
from rowlog.session import scratch_path
from rowlog.sinks.parquet import read_lake, write_by_table
from rowlog.streaming import stream
from rowlog.streaming.gate import LogGate


def whole_log(spark, name="mysql-bin.000001", n=3):
    """A framed log of n transactions: FORMAT_DESCRIPTION, 6 n events, ROTATE."""
    events = [{"t": "FORMAT_DESCRIPTION"}]
    for k in range(n):
        events += txn(k + 1, 9, "db", "t", ["id"], "EXT_WRITE_ROWS", [[None, [str(k)]]], f"insert {k}")
    return raw_df(spark, [*events, {"t": "ROTATE"}], binarylog=name).cache()


def seqs(df, name="mysql-bin.000001"):
    return sorted(r.seq for r in df.where(F.col("binarylog") == name).collect())


def test_a_log_in_pieces_is_held_until_it_is_whole(spark):
    log, other = whole_log(spark), whole_log(spark, "mysql-bin.000002", 1)
    gate = LogGate(spark, scratch_path(spark, "t-gate"))
    first = gate.take(log.where("seq < 8").unionByName(other), 0)
    assert seqs(first) == [] and seqs(first, "mysql-bin.000002") == list(range(8))
    assert [(r.binarylog, r.events, r.since) for r in gate.open_logs().collect()] == [("mysql-bin.000001", 8, 0)]
    # The end comes before the middle: still not whole. An event lands twice.
    assert gate.take(log.where("seq >= 12 or seq = 7"), 1).count() == 0
    for _ in range(2):  # the batch may be run again
        assert seqs(gate.take(log.where("seq between 8 and 11"), 2)) == list(range(20))
    assert gate.open_logs().count() == 0
    gate.take(whole_log(spark, "mysql-bin.000003", 1), 3)
    assert gate._batches("held") == [3] and gate._batches("open") == [2, 3]


def test_a_log_that_lands_again_starts_anew(spark):
    """Held events of its first landing are still there, as another log is open since; they don't count again."""
    log, other = whole_log(spark), whole_log(spark, "mysql-bin.000002", 1)
    gate = LogGate(spark, scratch_path(spark, "t-gate5"))
    gate.take(log.where("seq < 8").unionByName(other.where("seq < 3")), 0)
    assert gate.take(log.where("seq >= 8"), 1).count() == 20
    assert gate.take(log, 2).count() == 20 and gate._batches("held") == [0, 1, 2]
    assert gate.take(other.where("seq >= 3"), 3).count() == 8


def test_doubled_events_do_not_make_up_for_missing_ones(spark):
    log = whole_log(spark)
    gate = LogGate(spark, scratch_path(spark, "t-gate2"))
    twice = log.where("seq <> 5").unionByName(log.where("seq = 6"))  # as many events as numbers
    assert gate.take(twice, 0).count() == 0 and gate.open_logs().count() == 1


def test_closed_logs_need_no_rotate(spark):
    log = whole_log(spark).where("event_type <> 'ROTATE'")
    closed = scratch_path(spark, "t-closed")
    spark.createDataFrame([(1, "other")], "server_id long, binarylog string").write.parquet(closed)
    gate = LogGate(spark, scratch_path(spark, "t-gate3"), closed)
    assert gate.take(log, 0).count() == 0
    spark.createDataFrame([(1, "mysql-bin.000001")], "server_id long, binarylog string").write.mode("append").parquet(closed)
    assert gate.take(log.where("false"), 1).count() == 19
    headless = whole_log(spark).where("event_type <> 'FORMAT_DESCRIPTION'")
    assert LogGate(spark, scratch_path(spark, "t-gate4")).take(headless, 0).count() == 0


@pytest.fixture(scope="module")
def changes(spark):
    return build_changes(fx.shop_log(spark, SF)).cache()


def test_live_counts_follow_rewrites(spark, changes):
    """The rate and the shapes are those of the newest snapshot, whatever a rewrite drops or adds."""
    lake, rate, shapes, c1, c2 = (scratch_path(spark, f"t-live-{k}") for k in range(5))
    part = changes.where("server_id <> 2 or event = 'EXT_WRITE_ROWS'")
    for now in (changes, changes, part, changes.where("server_id = 4")):
        write_by_table(now, lake, by_file=True)
        stream.stream_write_rate(spark, lake, rate, c1).awaitTermination()
        stream.stream_query_shapes(spark, lake, shapes, c2).awaitTermination()
        want = read_lake(spark, lake, by_file=True)
        got = spark.read.parquet(rate).select("table", "op", "bucket_start", "n")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, write_rate(want).select("table", "op", "bucket_start", "n").collect()))
        seen = want.groupBy("query_hash").agg(F.min("timestamp").alias("first_seen"), F.count("*").alias("rows_affected"))
        assert sorted(map(tuple, spark.read.parquet(shapes).collect())) == sorted(map(tuple, seen.collect()))
    assert read_lake(spark, lake, by_file=True).count() == part.count()


def test_live_storms_equal_the_batch_on_closed_days(spark, changes):
    lake, out, ckpt = (scratch_path(spark, f"t-storms-{k}") for k in range(3))
    orders = changes.where("server_id < 4")
    low, high = orders.agg(F.min("timestamp"), F.max("timestamp")).first()
    last = None
    for share in (0.3, 0.7, 1.0):
        write_by_table(orders.where(F.col("timestamp") <= int(low + (high - low) * share)), lake, by_file=True)
        last = stream.stream_delete_storms(spark, lake, out, ckpt, watermark="2 days", min_deletes=1)
        last.awaitTermination()
    day = 86_400_000
    want = delete_storms(orders, min_deletes=1).where(F.col("bucket_start") + day <= high - 2 * day)
    cols = ["table", "bucket_start", "deletes", "trailing_deletes", "is_storm"]
    got = sorted(map(tuple, spark.read.parquet(out).select(*cols).collect()))
    assert got == sorted(map(tuple, want.select(*cols).collect())) and got
    assert stream.late_rows(last) > 0  # the rewritten rows of closed days


def test_landed_files_are_archived_or_deleted(spark):
    for how in ("archive", "delete"):
        src, dst, ckpt, away = (scratch_path(spark, f"t-{how}-{k}") for k in range(4))
        for k in (1, 2, 3):
            whole_log(spark, f"mysql-bin.00000{k}", k).coalesce(1).write.mode("append").parquet(src)
            stream.stream_convert(spark, src, dst, ckpt, clean_source=how, archive_dir=away if how == "archive" else None, fingerprints=False).awaitTermination()
        folder = src.removeprefix("file:")
        until = time.time() + 30
        while len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1 and time.time() < until:
            time.sleep(0.5)
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 1
        kept = sum(f.endswith(".parquet") for _, _, names in os.walk(away.removeprefix("file:")) for f in names)
        assert (kept >= 2) == (how == "archive")
        assert read_lake(spark, dst, by_file=True).count() == 6
