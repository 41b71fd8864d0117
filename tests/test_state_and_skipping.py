"""State tables against full replays; files skipped by indexed values; images parsed once."""
import random

import pytest
from helpers import SF, raw_df, txn
from pyspark.sql import functions as F

from checks import fixtures as fx
from rowlog.functions import images as fi
from rowlog.operators.history import state_at
from rowlog.operators.statetable import StateTable
from rowlog.operators.workload import first_set, transitions
from rowlog.plans.convert import build_changes
from rowlog.session import scratch_path
from rowlog.sinks import manifest
from rowlog.sinks.parquet import write_by_table
from rowlog.sinks.skipping import files_with, index_columns, lookup


@pytest.fixture(scope="module")
def accounts(spark):
    return build_changes(fx.accounts_log(spark, SF), fingerprints=False).where("table = 'shop.acct_book'").cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_states_equal_full_replays(spark, accounts):
    """Keys that move, at instants on and between steps; times that run against log order."""
    shuffled = accounts.withColumn("timestamp", F.col("timestamp") + F.pmod(F.hash("position"), F.lit(40)) * 600_000)
    keys = {"id": "bigint"}
    low, high = shuffled.agg(F.min("timestamp"), F.max("timestamp")).first()
    table = StateTable(spark, scratch_path(spark, "t-state"), keys, fanout=2)
    steps = [int(low + (high - low) * k / 9) for k in range(1, 8)]
    for t in steps:
        table.advance(shuffled, t)
        table.advance(shuffled, t)  # nothing more to take in
    assert [len([s for s in table.segments() if s.level == k]) for k in range(4)] == [7, 3, 1, 0]
    assert [s.level for s in table.cover(steps[6])] == [2, 1, 0] and table.cover(low - 1) == []
    for t in (low, steps[0], (steps[2] + steps[3]) // 2, steps[5], high):
        assert rows(table.at(shuffled, t)) == rows(state_at(shuffled, keys, t))
    assert table.unseen(shuffled) == 0


def test_only_changes_after_the_base_are_read(spark, accounts):
    root = scratch_path(spark, "t-state-lake")
    accounts.write.parquet(root)
    lake, keys = spark.read.parquet(root), {"id": "bigint"}
    table = StateTable(spark, scratch_path(spark, "t-state2"), keys)
    low, high = accounts.agg(F.min("timestamp"), F.max("timestamp")).first()
    table.advance(lake, (low + high) // 2)
    plan = table.at(lake, high)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and "timestamp" in x]
    assert len(scans) == 1 and f"GreaterThan(timestamp,{(low + high) // 2})" in scans[0]


def test_late_changes_are_told_and_rebuilt(spark, accounts):
    keys = {"id": "bigint"}
    low, high = accounts.agg(F.min("timestamp"), F.max("timestamp")).first()
    table = StateTable(spark, scratch_path(spark, "t-state3"), keys, fanout=2)
    some = accounts.where("position % 1000 < 600")
    for t in ((low + high) // 2, high):
        table.advance(some, t)
    late = accounts.count() - some.count()
    assert table.unseen(accounts) == late > 0
    table.rebuild(accounts)
    assert table.unseen(accounts) == 0 and rows(table.at(accounts, high)) == rows(state_at(accounts, keys, high))


def test_a_lookup_skips_files(spark):
    orders = build_changes(fx.orders_log(spark, "/root/testdata/sf0.01"), fingerprints=False)
    root = scratch_path(spark, "t-index")
    write_by_table(orders, root, by_file=True)
    n = manifest.live(spark, root).count()
    assert index_columns(spark, root, "shop.orders", ["o_orderkey", "o_orderstatus", "nothing"]) == n >= 20
    assert index_columns(spark, root, "shop.orders", ["o_orderkey", "nothing"]) == 0
    for key in (17, 9000, 1234):
        left = files_with(spark, root, "shop.orders", {"o_orderkey": key}).count()
        assert 1 <= left <= n // 5
        got = lookup(spark, root, "shop.orders", {"o_orderkey": key})
        assert len(got.inputFiles()) == left
        want = orders.where((F.get_json_object("data", "$.o_orderkey") == str(key)) | (F.get_json_object("old", "$.o_orderkey") == str(key)))
        assert rows(got.select("position", "data")) == rows(want.select("position", "data")) and got.count()
    assert files_with(spark, root, "shop.orders", {"o_orderkey": -5}).count() == 0
    assert files_with(spark, root, "shop.orders", {"nothing": 1}).count() == 0
    assert lookup(spark, root, "shop.orders", {"o_orderkey": 17, "o_orderstatus": "none"}).count() == 0
    write_by_table(orders.where("server_id = 1"), root, by_file=True)  # new files have no entry: they are read
    assert files_with(spark, root, "shop.orders", {"o_orderkey": -5}).count() == manifest.live(spark, root).where("server_id = 1").count()


ODD = ["a", "a.b", "q'x", 'd"x', "é n", "[0]", "$", ""]


def test_variant_reads_equal_plain_ones(spark):
    r = random.Random(4)
    cells = ["1", "-2.50", "100.00", "1e3", "true", "false", "null", '"x"', '"1.0"', '""', '"a\\"b"', '"é\\n"', "0", "12345678901234567890", "[1, 2]", '{"k": 1}']
    events = []
    for k in range(60):
        before, after = ([r.choice(cells) for _ in ODD] for _ in range(2))
        events += txn(k + 1, 5, "db", "t", ODD, "EXT_UPDATE_ROWS", [[before, after]], "u")
    ch = build_changes(raw_df(spark, events)).cache()
    for name in ODD:
        for image in ("data", "old"):
            plain, fast = fi.image_col(image, name), fi.once(fi.parsed(image), lambda v, i=image: fi.image_col(i, name, variant=v))
            has = fi.once(fi.parsed(image), lambda v, i=image: fi.image_has(i, name, v))
            bad = ch.select(image, plain.alias("p"), fast.alias("f"), has.alias("h")).where("not (p <=> f) or not h")
            # Nested values are JSON text either way, but spaced by each parser in its own way.
            assert [x for x in bad.collect() if not (x.h and x.p and x.p[0] in "[{")] == []
        for side in ("old", "new"):
            plain, fast = fi.change_col("changed", name, side), fi.once(fi.parsed("changed"), lambda v: fi.change_col("changed", name, side, v))
            has = fi.once(fi.parsed("changed"), lambda v: fi.has_change("changed", name, v)) != fi.has_change("changed", name)
            bad = ch.select("changed", plain.alias("p"), fast.alias("f"), has.alias("h")).where("not (p <=> f) or h")
            assert [x for x in bad.collect() if x.h or not (x.p and x.p[0] in "[{")] == []
    with pytest.raises(ValueError, match="no variant path"):
        fi.image_col("data", "'\"", variant=F.lit(None))


def test_one_parse_a_row(spark, accounts):
    for df in (transitions(accounts, "amount", "100.00", "75.00"), first_set(accounts, {"id": "bigint"}, "amount", "75.00")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        images = {"changed": 0, "data": 0}
        for image in images:
            images[image] = plan.count(f"parse_json({image}#") + plan.count(f"from_json(MapType(StringType,StringType,true), {image}#")
        assert all(v <= 2 for v in images.values()) and "from_json" not in plan
    one = transitions(accounts, "amount", "100.00", "75.00")._jdf.queryExecution().optimizedPlan().toString()
    assert one.lower().count("parse_json") + one.count("VariantExpressionEvalUtils") <= 2 and "from_json" not in one
