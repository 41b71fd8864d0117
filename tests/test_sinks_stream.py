"""Lake writes, read-back, audit, plan properties and the streaming job."""
from helpers import SF
from pyspark.sql import functions as F

from rowlog.operators.history import state_at
from rowlog.operators.protect import filter_tables
from rowlog.operators.sequence import sequence_events
from rowlog.plans.convert import build_changes, convert
from rowlog.session import scratch_path
from rowlog.sinks.parquet import audit_output, read_lake, write_by_table, write_single
from checks import fixtures as fx
from rowlog.sources.raw import raw_events
from rowlog.streaming.stream import stream_convert


def test_lake_roundtrip_and_audit(spark):
    ch = build_changes(fx.shop_log(spark, SF), fingerprints=False)
    root = scratch_path(spark, "t-lake")
    write_by_table(ch, root)
    lake = read_lake(spark, root)
    assert lake.count() == ch.count()
    assert {r.table_key for r in lake.select("table_key").distinct().collect()} == {"shop.orders", "shop.customer"}
    one = read_lake(spark, root, tables=["shop.customer"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shop.customer" in plan
    exp = ch.groupBy("table").count().selectExpr("replace(table, ' ', '_') AS table_key", "count AS expected_rows")
    assert all(r.ok for r in audit_output(spark, root, exp).collect())


def test_dynamic_overwrite_is_idempotent(spark):
    ch = build_changes(fx.customer_log(spark, SF), fingerprints=False)
    root = scratch_path(spark, "t-lake2")
    write_by_table(ch, root, by_file=True, replace="touched")
    write_by_table(ch, root, by_file=True, replace="touched")
    assert read_lake(spark, root, by_file=True).count() == ch.count()


def test_single_output_is_ordered(spark):
    ch = build_changes(fx.orders_log(spark, SF), fingerprints=False)
    path = scratch_path(spark, "t-single")
    write_single(ch, path, files=1)
    back = [(r.server_id, r.binarylog, r.position, r.row_idx) for r in spark.read.parquet(path).collect()]
    assert len(back) == ch.count() and back == sorted(back)


def test_writer_options_and_order_of_files(spark):
    import glob

    import pyarrow.parquet as pq

    ch = build_changes(fx.shop_log(spark, SF), fingerprints=False)
    root = scratch_path(spark, "t-files")
    write_by_table(ch, root, by_file=True)
    files = glob.glob(root.removeprefix("file:") + "/generation=*/**/part-*.parquet", recursive=True)
    assert files
    for f in files:
        meta = pq.ParquetFile(f)
        group = meta.metadata.row_group(0)
        assert group.column(0).compression == "SNAPPY" and group.total_byte_size <= 16 << 20
        # Only pages of the second version have delta encodings.
        assert any("DELTA" in e for k in range(group.num_columns) for e in group.column(k).encodings)
        at = meta.read(["position", "row_idx"]).to_pydict()
        order = list(zip(at["position"], at["row_idx"], strict=True))
        assert order == sorted(order)


def test_a_rerun_with_fewer_tables_leaves_no_stale_one(spark):
    ch = build_changes(fx.accounts_log(spark, SF), fingerprints=False)
    other = ch.where("false")
    root = scratch_path(spark, "t-stale")
    two = ch.withColumn("table", F.when(F.col("position") % 200 == 4, "shop.a").otherwise("shop.b"))
    write_by_table(two, root, by_file=True)
    keep = build_changes(fx.customer_log(spark, SF), fingerprints=False)
    write_by_table(keep, root, by_file=True)
    write_by_table(ch.withColumn("table", F.lit("shop.b")), root, by_file=True)
    lake = read_lake(spark, root, by_file=True)
    assert {r.table_key for r in lake.select("table_key").distinct().collect()} == {"shop.b", "shop.customer"}
    assert lake.count() == ch.count() + keep.count()
    write_by_table(other, root, by_file=True)
    assert read_lake(spark, root, by_file=True).count() == ch.count() + keep.count()


def test_audit_reports_a_bad_lake(spark):
    ch = build_changes(fx.shop_log(spark, SF), fingerprints=False)
    root = scratch_path(spark, "t-bad")
    write_by_table(ch.where("table <> 'shop.customer' or position % 3 = 0"), root)
    exp = ch.groupBy("table").count().selectExpr("table AS table_key", "count AS expected_rows")
    assert {r.table_key: r.ok for r in audit_output(spark, root, exp).collect()} == {"shop.orders": True, "shop.customer": False}


def test_names_that_fold_together_stay_apart(spark):
    ch = build_changes(fx.accounts_log(spark, SF), fingerprints=False)
    root = scratch_path(spark, "t-fold")
    write_by_table(ch, root)
    for name in ("shop.acct book", "shop.acct_book"):
        got = read_lake(spark, root, tables=[name])
        assert {r.table for r in got.select("table").distinct().collect()} == {name}
        rest = filter_tables(read_lake(spark, root), deny=[name])
        assert got.count() + rest.count() == ch.count() and rest.count()


def test_statistics_of_a_conversion(spark):
    src, dst = scratch_path(spark, "t-ev"), scratch_path(spark, "t-job")
    fx.customer_log(spark, SF).write.parquet(src)
    done = convert(spark, src, dst)
    assert all(r.ok for r in done.audit.collect())
    assert done.file_summary.where("file_size > 0").count() == done.file_summary.count() > 0
    ops = done.table_op_counts.first()
    assert (ops.table_key, ops.total) == ("shop.customer", read_lake(spark, dst, by_file=True).count())
    assert done.event_type_counts.where("event_type = 'EXT_WRITE_ROWS'").first().rows == ops.writes
    assert done.rows == ops.total


def test_a_conversion_sequences_once(spark, monkeypatch):
    from rowlog.operators import sequence

    made, real = [], sequence.written
    monkeypatch.setattr(sequence, "written", lambda df, name: made.append(name) or real(df, name))
    src = scratch_path(spark, "t-once")
    fx.customer_log(spark, SF).write.parquet(src)
    done = convert(spark, src, scratch_path(spark, "t-once-lake"))
    assert made == ["sequence", "carry"] and all(r.ok for r in done.audit.collect())
    plain = convert(spark, src, scratch_path(spark, "t-plain-lake"), by_file=False)
    assert sorted(plain.table_op_counts.collect()) == sorted(done.table_op_counts.collect()) and all(r.ok for r in plain.audit.collect())
    assert plain.rows == done.rows


def test_stream_convert_equals_batch(spark):
    raw = fx.orders_log(spark, SF)
    src, dst = scratch_path(spark, "t-src"), scratch_path(spark, "t-dst")
    fx.framed(raw).repartition("server_id", "binarylog").write.parquet(src)
    stream_convert(spark, src, dst, scratch_path(spark, "t-ckpt"), fingerprints=False).awaitTermination()
    got = read_lake(spark, dst, by_file=True).select("binarylog", "position", "row_idx", "data", "gtid", "query")
    want = build_changes(raw, fingerprints=False).select("binarylog", "position", "row_idx", "data", "gtid", "query")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [line for line in plan.splitlines() if "FileScan" in line]


def test_conversion_plan(spark):
    """The raw events are read once for images, maps and texts each, with
    disjoint columns; the sorted sequence is read narrow; no Python."""
    src = scratch_path(spark, "t-plan")
    fx.orders_log(spark, SF).write.parquet(src)
    raw = raw_events(spark, src)
    plan, scans = _scans(build_changes(raw))
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "Window"))  # the sort is done and written
    events = [x for x in scans if "_b#" not in x]
    assert len(events) == 3 and all("PushedFilters: [" in x for x in events)
    assert [sum(f"{c}#" in x for x in events) for c in ("rows", "column_names", "query")] == [1, 1, 1]
    # the written sequence for row events and for table maps, each with the carry of its buckets
    assert len(scans) == 7 and sum("_carry_seg#" in x for x in scans) == 2
    sides = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(sides) + plan.count("BroadcastExchange") <= 13
    lazy, narrow = _scans(sequence_events(raw, store=False))
    assert "Window" in lazy
    assert narrow and not any(f"{c}#" in x for x in narrow for c in ("column_names", "db", "tbl"))


def test_state_at_pushes_the_instant(spark):
    root = scratch_path(spark, "t-push")
    write_by_table(build_changes(fx.orders_log(spark, SF), fingerprints=False), root)
    _, scans = _scans(state_at(read_lake(spark, root), {"o_orderkey": "bigint"}, 867_628_800_000))
    assert len(scans) == 1 and "LessThanOrEqual(timestamp,867628800000)" in scans[0]
