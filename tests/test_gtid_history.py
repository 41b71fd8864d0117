"""GTID set algebra and time travel."""
from helpers import UUID, raw_df
from pyspark.sql import functions as F

from rowlog.operators import gtid as og
from rowlog.operators import history as oh
from rowlog.plans.convert import build_changes

COLS = ["id", "v"]


def merged(spark, txns, bucket=1 << 20):
    df = spark.createDataFrame([(1, f"u:{t}") for t in txns] + [(1, f"a:{t}") for t in txns[:1]], "f long, gtid string")
    return og.runs_to_text(og.gtid_runs(df, ["f"], bucket=bucket), ["f"]).collect()[0].merged_gtids


def test_merge_rules(spark):
    for b in (1 << 20, 2, 3):
        assert merged(spark, [5, 5, 7], b) == "a:5,u:5:5:7"
        assert merged(spark, [3, 1, 2, 5], b) == "a:3,u:1-3:5"
        assert merged(spark, [5, 5, 6], b) == "a:5,u:5:5-6"
        assert merged(spark, [1, 2, 3, 4, 5, 6, 7, 9, 10, 11], b) == "a:1,u:1-7:9-11"


def test_repeated_numbers_keep_their_runs(spark):
    """As the reference: a run ends where its next number is repeated."""
    for b in (1 << 20, 2, 3):
        assert merged(spark, [1, 2, 2, 3, 3, 4], b) == "a:1,u:1-2:2-3:3-4"


def test_intervals_roundtrip(spark):
    df = spark.createDataFrame([(f"u:1-3:5,\n v:7",)], "s string")
    got = sorted(tuple(r) for r in og.gtid_intervals(df, "s").collect())
    assert got == [("u", 1, 3), ("u", 5, 5), ("v", 7, 7)]
    empty = spark.createDataFrame([("",)], "s string")
    assert og.gtid_intervals(empty, "s").count() == 0


def _ev(n, etype, rows):
    return [{"t": "GTID", "gtid": f"{UUID}:{n}"},
            {"t": "TABLE_MAP", "table_id": 1, "db": "d", "tbl": "t", "cols": COLS},
            {"t": etype, "table_id": 1, "rows": rows, "timestamp": 1000 * n}, {"t": "XID"}]


def history_changes(spark):
    ev = []
    ev += _ev(1, "EXT_WRITE_ROWS", [(None, ["1", '"a"']), (None, ["2", '"b"'])])
    ev += _ev(2, "EXT_UPDATE_ROWS", [(["1", '"a"'], ["1", '"a2"'])])
    ev += _ev(3, "EXT_UPDATE_ROWS", [(["2", '"b"'], ["3", '"b"'])])  # key change 2 -> 3
    ev += _ev(4, "EXT_DELETE_ROWS", [(["1", '"a2"'], None)])
    for i, e in enumerate(ev):
        e["timestamp"] = 1000 * (i // 4 + 1)
    return build_changes(raw_df(spark, ev))


def test_state_at(spark):
    ch = history_changes(spark)
    keys = {"id": "bigint"}
    st = lambda t, **kw: sorted(tuple(r) for r in oh.state_at(ch, keys, t, **kw).collect())
    assert st(1000) == [(1, '{"id":1,"v":"a"}'), (2, '{"id":2,"v":"b"}')]
    assert st(2000) == [(1, '{"id":1,"v":"a2"}'), (2, '{"id":2,"v":"b"}')]
    assert st(3000) == [(1, '{"id":1,"v":"a2"}'), (3, '{"id":3,"v":"b"}')]
    assert st(4000) == [(3, '{"id":3,"v":"b"}')]
    late = ch.where(F.col("timestamp") >= 2000)  # log retained from t=2000 on
    assert sorted(tuple(r) for r in oh.state_at(late, keys, 1500, use_preimage=True).collect()) == [
        (1, '{"id":1,"v":"a"}'), (2, '{"id":2,"v":"b"}')]


def test_bootstrap_equals_full_replay(spark):
    ch = history_changes(spark)
    keys = {"id": "bigint"}
    iv = og.intervals_of(spark, f"{UUID}:1-2")
    inside = ch.where(F.col("gtid_txn") <= 2)
    snap = oh.state_at(inside, keys, 1 << 62)
    got = sorted(tuple(r) for r in oh.bootstrap(snap, ch, iv, keys).collect())
    assert got == sorted(tuple(r) for r in oh.state_at(ch, keys, 1 << 62).collect())
    assert og.after_gtid_set(ch, iv).count() == 2


def test_row_history_buckets_equal_one_window(spark):
    """Bucketed history (carry over buckets of one key) equals one window per key."""
    from helpers import SF
    from pyspark.sql import Window

    from checks.catalog import ORDERS_KEYS, changes_of
    from rowlog.operators.workload import log_order

    ch = changes_of(spark, SF, "orders", fingerprints=False).cache()
    k = oh.key_columns(ch, ORDERS_KEYS)
    w = Window.partitionBy(*ORDERS_KEYS).orderBy(*log_order())
    want = sorted(tuple(r) for r in k.select(
        *ORDERS_KEYS, F.row_number().over(w).alias("version"), "event", "binarylog", "position", "data",
        F.lag("data").over(w).alias("prev_data"),
    ).collect())
    for b in (1, 997, oh.HISTORY_BUCKET):
        got = sorted(tuple(r) for r in oh.row_history(ch, ORDERS_KEYS, bucket=b).collect())
        assert got == want
    assert max(r[1] for r in want) > 1  # keys with several versions are covered


def test_row_history_null_key_is_one_key(spark):
    rows = [
        (1, "b.000001", 10, 0, "EXT_WRITE_ROWS", '{"id":null,"v":1}'),
        (1, "b.000001", 20, 0, "EXT_UPDATE_ROWS", '{"id":null,"v":2}'),
        (1, "b.000002", 5, 0, "EXT_UPDATE_ROWS", '{"id":null,"v":3}'),
        (1, "b.000002", 6, 0, "EXT_WRITE_ROWS", '{"id":7,"v":1}'),
    ]
    df = spark.createDataFrame(rows, "server_id long, binarylog string, position long, row_idx int, event string, data string")
    for b in (1, oh.HISTORY_BUCKET):
        key = lambda t: (-1 if t[0] is None else t[0], t[1])
        got = sorted(((r.id, r.version, r.position, r.prev_data) for r in oh.row_history(df, {"id": "bigint"}, bucket=b).collect()), key=key)
        assert got == [
            (None, 1, 10, None), (None, 2, 20, '{"id":null,"v":1}'), (None, 3, 5, '{"id":null,"v":2}'), (7, 1, 6, None),
        ]


def test_row_history_ends_a_moved_key(spark):
    got = {}
    for b in (1, oh.HISTORY_BUCKET):
        rows = oh.row_history(history_changes(spark), {"id": "bigint"}, bucket=b).orderBy("id", "version").collect()
        got[b] = [(r.id, r.version, r.data, r.prev_data) for r in rows]
    assert got[1] == got[oh.HISTORY_BUCKET] == [
        (1, 1, '{"id":1,"v":"a"}', None), (1, 2, '{"id":1,"v":"a2"}', '{"id":1,"v":"a"}'),
        (1, 3, '{"id":1,"v":"a2"}', '{"id":1,"v":"a2"}'),
        (2, 1, '{"id":2,"v":"b"}', None), (2, 2, None, '{"id":2,"v":"b"}'),
        (3, 1, '{"id":3,"v":"b"}', None),
    ]


def test_very_wide_gtid_intervals(spark):
    ch = spark.createDataFrame([(1, "u", 5), (2, "u", 2**62), (3, "u", 2**40), (4, "v", 5), (5, None, None)], "i int, gtid_uuid string, gtid_txn long")
    iv = spark.createDataFrame([("u", 1, 2**63 - 1), ("u", 4, 6), ("v", 7, 9)], "uuid string, lo long, hi long")
    assert sorted(r.i for r in og.in_gtid_set(ch, iv).collect()) == [1, 2, 3]
    assert sorted(r.i for r in og.after_gtid_set(ch, iv).collect()) == [4, 5]


def test_transaction_scope_keeps_rows_outside_transactions(spark):
    from rowlog.operators.workload import co_changed

    df = spark.createDataFrame([(1, "b", 10, "4", "x"), (1, "b", 20, "4", "y"), (1, "b", 30, None, "x"), (1, "b", 40, None, "y")],
                               "server_id long, binarylog string, position long, gtid_position string, v string")
    got = co_changed(df, F.col("v") == "x", "transaction")
    assert sorted(r.position for r in got.collect()) == [10, 20, 30]


def test_protection_leaves_no_clear_text(spark):
    import pytest
    from checks import fixtures as fx
    from helpers import SF

    from rowlog.operators.protect import decrypt_images, encrypt_images

    raw = fx.customer_log(spark, SF)
    ch = build_changes(raw, redact={"shop.customer": {"c_name": "hash"}})
    assert not any("Customer#" in str(r) for r in ch.collect())
    clear = build_changes(raw, fingerprints=False).select("data", "old", "changed", "query")
    with pytest.raises(TypeError, match="literal"):
        encrypt_images(clear, "0123456789abcdef0123456789abcdef")
    key = spark.range(1).select(F.substring(F.sha2(F.lit("k").cast("binary"), 256), 1, 32).alias("k"))
    enc = encrypt_images(clear, key.scalar())
    assert not any("Customer#" in str(r) for r in enc.collect())
    back = decrypt_images(enc, key.scalar())
    assert back.exceptAll(clear).count() == 0 and back.count() == clear.count()
