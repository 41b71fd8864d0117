"""What keeps a task's share bounded: rows that move once, streamed single files, small join sides."""
import re

import pytest
from helpers import SF, UUID, raw_df

from pyspark.sql import functions as F

from checks import fixtures as fx
from rowlog.functions.fingerprint import fingerprint
from rowlog.functions.images import json_string, quoted_names
from rowlog.operators import sequence, workload
from rowlog.plans.convert import build_changes, sequenced
from rowlog.sinks import parquet


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_meet_images_and_texts_where_they_are(spark, no_broadcast):
    plan = _plan(build_changes(fx.customer_log(spark, SF)))
    dealt = [re.findall(r"(\w+)#", d) for d in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
    file = ["server_id", "binarylog"]
    assert dealt.count([*file, "_place"]) == 3  # rows, images, texts
    assert [*file, "seq"] not in dealt and [*file, "query_seq"] not in dealt
    assert dealt.count([*file, "segment", "table_id"]) >= 2  # rows and last maps


@pytest.mark.parametrize("place", [1, 3, 1 << 16])
@pytest.mark.parametrize("scope", ["file", "txn"])
def test_texts_from_another_place(spark, monkeypatch, place, scope):
    """A text is found from any distance, also where two events have its number."""
    monkeypatch.setattr(sequence, "PLACE_BUCKET", place)
    m = {"t": "TABLE_MAP", "table_id": 5, "db": "d", "tbl": "t", "cols": ["v"]}
    w = {"t": "EXT_WRITE_ROWS", "table_id": 5, "rows": [(None, ["1"])]}
    ev = [{"t": "GTID", "gtid": f"{UUID}:1"}, {"t": "ROWS_QUERY", "query": "a"}, m, *[w] * 6, {"t": "XID"},
          {"t": "GTID", "gtid": f"{UUID}:2"}, m, w, {"t": "ROWS_QUERY", "query": "b"}, {"t": "ROWS_QUERY", "query": "c", "seq": 13}, w, w]
    got = build_changes(raw_df(spark, ev), query_scope=scope).orderBy("seq", "query").collect()
    late = "a" if scope == "file" else None
    assert [r.query for r in got][:7] == ["a"] * 6 + [late]
    assert sorted(r.query for r in got[7:]) == ["b", "b", "c", "c"]  # both texts of number 13, for each of two rows


def test_state_is_carried_over_some_buckets_only(spark, no_broadcast):
    """The carried state has a row for each bucket that follows another, none for a log's first one."""
    raw = raw_df(spark, [{"t": "GTID", "gtid": f"{UUID}:1"}, {"t": "QUERY"}, {"t": "XID"}]).unionByName(
        raw_df(spark, [{"t": "GTID", "gtid": f"{UUID}:{n}"} for n in range(2, 7)], binarylog="mysql-bin.000002"))
    seq = sequenced(raw, bucket_size=2)
    files = {f for f in seq.inputFiles() if "/carry-" in f}
    assert spark.read.parquet(*files).count() == 3
    one = sequenced(raw, method="window")
    assert seq.exceptAll(one).count() == 0 and one.exceptAll(seq).count() == 0


def test_shuffles_grow_by_partitions(spark):
    """A join's tasks are merged from many partitions, so that their size holds."""
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1024


def test_a_single_file_is_copied_not_sorted(spark):
    rows = parquet._in_one_task(spark.range(0, 1000, 1, 7).orderBy("id"))
    assert rows.rdd.getNumPartitions() == 1
    assert not re.search(r"\b(Sort|Exchange)\b", _plan(rows))
    assert [r.id for r in rows.collect()] == list(range(1000))
    assert parquet._in_one_task(spark.range(0).orderBy("id")).count() == 0


def test_silent_tables_compare_tables_not_rows(spark, no_broadcast):
    changes = spark.createDataFrame([("a", 5), ("a", 6), ("b", 50)], "table string, timestamp long")
    got = workload.silent_tables(spark.createDataFrame([("a",), ("b",), (None,)], "table string"), changes, 0, 10)
    assert sorted(str(r.table) for r in got.collect()) == ["None", "b"]
    right = got._jdf.queryExecution().optimizedPlan().toString().split("Filter")[0]
    assert right.count("Aggregate") == 2


def test_an_index_sends_the_list_of_files_to_the_images(spark, no_broadcast, tmp_path, monkeypatch):
    """However long the list is; and columns indexed one after the other are indexed as at once."""
    from rowlog.sinks import skipping

    lake, plans = str(tmp_path / "lake"), []
    parquet.write_by_table(build_changes(fx.customer_log(spark, SF), fingerprints=False), lake, by_file=True)
    read = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, path, *a, **k: (plans.append(_plan(self._df)), read(self, path, *a, **k))[1])
    n = skipping.index_columns(spark, lake, "shop.customer", ["c_custkey"])
    assert n and skipping.index_columns(spark, lake, "shop.customer", ["c_custkey", "c_name"]) == n
    for plan in plans:
        assert plan.count("Generate explode(concat") == 1  # images are read once
        assert "BroadcastHashJoin" in plan
    entries = spark.read.schema(skipping.INDEX_SCHEMA).parquet(f"{lake}/_index/*")
    assert sorted(r["count"] for r in entries.groupBy("column", "file").count().collect()) == [1] * (2 * n)
    hit = skipping.lookup(spark, lake, "shop.customer", {"c_custkey": 5})
    assert hit.count() == 2  # inserted, and raised


def test_bucket_state_takes_one_running_frame(spark):
    """Beside the look at the next event, a bucket's state is running results
    over one frame: what was before an event."""
    plan = _plan(sequenced(fx.customer_log(spark, SF), store=False)).lower()
    assert "unboundedpreceding$(), -1)" in plan
    assert not re.search(r"_b#\w+, seq#\w+ asc nulls first, specifiedwindowframe\(rowframe, unboundedpreceding\$\(\), currentrow", plan)


def test_a_text_goes_only_through_patterns_it_may_hold(spark):
    texts = ["a", "a = 'x''y'", "a\t\n in\x0b( 1 , -2,3 )", "f(1 ,2) /* b */ -- c", "x = - 1 # d", "VALUES (1, 2), (3,4)", "'it\\'s', ,b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fingerprint("t").alias("f"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"CASE WHEN", plan)) >= 9  # all patterns but that of literals
    assert [r.f for r in df.collect()] == ["a", "a = ?", "a IN (...)", "f(?, ?)", "x = ?", "VALUES (?, ?)", "?, , b", None]


def test_names_without_escapes_are_quoted_as_they_are(spark):
    names = [["a", "b c"], [], [""], ['q"', "x"], ['a","b'], ["n", None], [None], ["\u00e9\\", "/", "\t"], None]
    df = spark.createDataFrame([(n,) for n in names], "n array<string>")
    got = df.select(quoted_names("n").alias("q"), F.transform("n", lambda n: json_string(n)).alias("w"))
    assert "array_join" in got._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.q == r.w for r in got.collect())


def test_a_sorted_output_makes_its_changes_once(spark, tmp_path, monkeypatch):
    """A range-partitioned sort reads its rows twice: written ones, then."""
    plans, write = [], type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, path, *a, **k: (plans.append(_plan(self._df)), write(self, path, *a, **k))[1])
    parquet.write_single(build_changes(fx.customer_log(spark, SF), fingerprints=False), str(tmp_path / "one"))
    assert "rangepartitioning" in plans[-1] and "Join" not in plans[-1] and "Generate" not in plans[-1]
    assert spark.read.parquet(str(tmp_path / "one")).count() == 180


def _tasks(spark, group, job):
    """The most tasks that a stage of the job's has."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s))


def test_folders_of_logs_are_listed_by_few_tasks(spark, tmp_path):
    """A lake of 180 logs: a task lists many folders, both to commit and to read."""
    logs = build_changes(fx.customer_log(spark, SF), fingerprints=False).withColumn("binarylog", F.format_string("cust-bin.%06d", "position"))
    lake = str(tmp_path / "lake")
    most = _tasks(spark, "write", lambda: parquet.write_by_table(logs.coalesce(8), lake, by_file=True))
    assert most <= 96
    assert _tasks(spark, "read", lambda: parquet.read_lake(spark, lake, by_file=True)) <= 96
    back = parquet.read_lake(spark, lake, by_file=True)
    assert back.count() == 180 and back.select("log_seq").distinct().count() == 180


def test_counts_leave_the_cells_of_images_behind(spark):
    """Where no image is wanted, none moves: its rows do."""
    changes = build_changes(fx.lineitem_log(spark, SF), fingerprints=False)

    def moved(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if re.search(r"Project .* AS _place#", line) and "image#" in line]

    assert moved(changes) and not moved(workload.table_event_counts(changes))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert [tuple(r) for r in workload.table_event_counts(changes).collect()] == [("shop.lineitem", "EXT_WRITE_ROWS", lines)]


def test_images_of_events_with_one_number(spark):
    """Each of two events that share a number meets the images of both; null and empty arrays give no rows."""
    m = {"t": "TABLE_MAP", "table_id": 5, "db": "d", "tbl": "t", "cols": ["v"]}
    w = {"t": "EXT_WRITE_ROWS", "table_id": 5}
    ev = [{"t": "GTID", "gtid": f"{UUID}:1"}, m, {**w, "rows": [(None, ["1"]), (None, ["2"])]}, {**w, "rows": [(None, ["3"])], "seq": 2},
          {**w, "rows": []}, w, {**w, "rows": [(None, ["4"]), (None, None)]}]
    got = build_changes(raw_df(spark, ev)).select("seq", "row_idx", "data").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(2, 0, '{"v":1}'), (2, 1, '{"v":2}'), (2, 0, '{"v":3}')] * 2 + [(6, 0, '{"v":4}'), (6, 1, None)], key=str)
