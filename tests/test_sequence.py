"""Per-file state rules (edge cases) and carry == window equivalence."""
import pytest
from helpers import SF, UUID, raw_df

from rowlog.operators import stats
from rowlog.operators.sequence import sequence_events
from rowlog.plans.convert import build_changes, sequenced
from checks import fixtures as fx
from rowlog.sources.raw import assert_event_types

COLS = ["id", "v"]


def tm(tid=5, tbl="t"):
    return {"t": "TABLE_MAP", "table_id": tid, "db": "d", "tbl": tbl, "cols": COLS}


def w(tid=5, v="1"):
    return {"t": "EXT_WRITE_ROWS", "table_id": tid, "rows": [(None, ["1", v])]}


@pytest.mark.parametrize("method,bucket", [("window", 1 << 20), ("carry", 1 << 20), ("carry", 2), ("carry", 3)])
def test_rules(spark, method, bucket):
    ev = [
        {"t": "GTID", "gtid": f"{UUID}:1"},
        {"t": "ROWS_QUERY", "query": "q1"},
        tm(tbl="v1"), w(v="a"), tm(tbl="v2"), w(v="b"),  # map replaced: both rows see v2
        {"t": "XID"},
        tm(tbl="v3"), w(v="c"),  # after XID: no gtid, map of same segment (v3 is the last map)
        {"t": "GTID", "gtid": f"{UUID}:2"},
        tm(), w(v="d"),  # stale SQL text q1
        {"t": "GTID", "gtid": f"{UUID}:3"},
        {"t": "ROWS_QUERY", "query": "q3"}, tm(), {"t": "EXT_WRITE_ROWS", "table_id": 5, "rows": []}, w(v="e"),
        {"t": "XID"},
    ]
    raw = raw_df(spark, ev)
    ch = build_changes(raw, method=method, bucket_size=bucket).orderBy("position").collect()
    assert [r.data for r in ch] == ['{"id":1,"v":a}', '{"id":1,"v":b}', '{"id":1,"v":c}', '{"id":1,"v":d}', '{"id":1,"v":e}']
    assert [r.table for r in ch] == ["d.v3", "d.v3", "d.v3", "d.t", "d.t"]
    assert [r.gtid for r in ch] == [f"{UUID}:1", f"{UUID}:1", None, f"{UUID}:2", f"{UUID}:3"]
    assert [r.query for r in ch] == ["q1", "q1", "q1", "q1", "q3"]
    assert ch[0].gtid_position == "4"  # the first event starts at offset 4
    assert [r.counter for r in ch] == [1, 2, 3, 4, 5]
    cap = {r.gtid: (r.committed, r.captured_events) for r in stats.captured_transactions(
        sequenced(raw, method=method, bucket_size=bucket)).collect()}
    # txn 1: committed, row events after its XID still land in its list
    assert cap == {f"{UUID}:1": (True, 3), f"{UUID}:2": (False, None), f"{UUID}:3": (True, 2)}
    # txn scope: txn 2 has no SQL text of its own
    q = build_changes(raw, method=method, bucket_size=bucket, query_scope="txn").orderBy("position").collect()
    assert [r.query for r in q] == ["q1", "q1", "q1", None, "q3"]


def test_missing_map_and_unknown_type(spark):
    raw = raw_df(spark, [{"t": "GTID", "gtid": f"{UUID}:1"}, w(), {"t": "XID"}])
    with pytest.raises(Exception, match="no table map"):
        build_changes(raw).collect()
    assert build_changes(raw, missing="null").collect()[0].table is None
    bad = raw_df(spark, [{"t": "GTID", "gtid": f"{UUID}:1"}, {"t": "STOP"}])
    with pytest.raises(Exception, match="Unexpected event type"):
        assert_event_types(bad).groupBy("event_type").count().collect()
    ok, rej = assert_event_types(bad, on_error="quarantine")
    assert ok.count() == 1 and rej.collect()[0].event_type == "STOP"


def test_noop_update_and_nulls(spark):
    ev = [{"t": "GTID", "gtid": f"{UUID}:1"}, tm(),
          {"t": "EXT_UPDATE_ROWS", "table_id": 5, "rows": [(["1", "2"], ["1", "2"]), (["1", None], ["1", "3"]),
                                                           (["1", "4"], ["1", None]), (["1", "1.0"], ["1", "1.00"])]}]
    ch = build_changes(raw_df(spark, ev)).orderBy("row_idx").collect()
    assert [(r.changed, r.columns) for r in ch] == [
        ("{}", "[]"),
        ('{"v":{"old":null,"new":3}}', '["v"]'),
        ('{"v":{"old":4,"new":null}}', '["v"]'),
        ('{"v":{"old":1.0,"new":1.00}}', '["v"]'),
    ]


@pytest.mark.parametrize("bucket", [7, 64, 1000])
def test_carry_equals_window_on_control_stream(spark, bucket):
    raw = fx.control_stream(spark, SF)
    a = sequence_events(raw, method="window")
    b = sequence_events(raw, method="carry", bucket_size=bucket)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    for scope in ("txn",):
        a = sequence_events(raw, method="window", query_scope=scope)
        b = sequence_events(raw, method="carry", bucket_size=bucket, query_scope=scope)
        assert a.exceptAll(b).count() == 0


def test_carry_equals_window_changes(spark):
    raw = fx.orders_log(spark, SF)
    a = build_changes(raw, method="window")
    b = build_changes(raw, method="carry", bucket_size=50)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_fixture_logs_have_one_event_a_place(spark):
    from checks.catalog import LOGS

    for name, log in LOGS.items():
        raw = log(spark, "/root/testdata/sf0.01")
        assert raw.groupBy("server_id", "binarylog", "seq").count().where("count > 1").count() == 0, name


def test_strict_updates(spark):
    ev = [{"t": "GTID", "gtid": f"{UUID}:1"}, tm(), {"t": "EXT_UPDATE_ROWS", "table_id": 5, "rows": [(["1"], ["1", "2"])]}]
    with pytest.raises(Exception, match="differ in length"):
        build_changes(raw_df(spark, ev), strict=True).collect()


def test_a_cluster_without_a_shared_folder_is_an_error():
    from rowlog.session import shared_dir

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared_dir(Session())
