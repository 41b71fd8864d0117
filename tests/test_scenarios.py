"""The reference's three end-to-end scenarios, as hand-built decoded events."""
from helpers import UUID, raw_df, txn
from pyspark.sql import functions as F

from rowlog.operators import stats
from rowlog.plans.convert import build_changes

CUST = ["id", "name", "email"]
ITEMS = ["id", "sku", "qty", "created_at"]
T = '"2026-04-28T22:14:01.000+00:00"'


def scenario01(spark):
    ev = [{"t": "FORMAT_DESCRIPTION"}, {"t": "PREVIOUS_GTIDS", "previous_gtids": ""}]
    ev += [{"t": "GTID", "gtid": f"{UUID}:1"}, {"t": "QUERY"}, {"t": "GTID", "gtid": f"{UUID}:2"}, {"t": "QUERY"}]
    ev += txn(3, 90, "binlogtest", "customers", CUST, "EXT_WRITE_ROWS",
              [(None, ["1", '"Alice"', '"alice@example.com"']), (None, ["2", '"Bob"', '"bob@example.com"'])],
              "INSERT INTO customers (name, email) VALUES ('Alice', 'alice@example.com'), ('Bob', 'bob@example.com')")
    ev += txn(4, 91, "binlogtest", "items", ITEMS, "EXT_WRITE_ROWS",
              [(None, ["1", '"sku-0001"', "10", T]), (None, ["2", '"sku-0002"', "25", T]), (None, ["3", '"sku-0003"', "5", T])],
              "INSERT INTO items (sku, qty) VALUES ('sku-0001', 10), ('sku-0002', 25), ('sku-0003', 5)")
    ev += txn(5, 91, "binlogtest", "items", ITEMS, "EXT_UPDATE_ROWS",
              [(["1", '"sku-0001"', "10", T], ["1", '"sku-0001"', "11", T])],
              "UPDATE items SET qty = 11 WHERE sku = 'sku-0001'")
    ev += txn(6, 90, "binlogtest", "customers", CUST, "EXT_UPDATE_ROWS",
              [(["1", '"Alice"', '"alice@example.com"'], ["1", '"Alice"', '"alice+new@example.com"'])],
              "UPDATE customers SET email = 'alice+new@example.com' WHERE name = 'Alice'")
    ev += txn(7, 91, "binlogtest", "items", ITEMS, "EXT_DELETE_ROWS",
              [(["2", '"sku-0002"', "25", T], None)], "DELETE FROM items WHERE sku = 'sku-0002'")
    ev += [{"t": "ROTATE", "next_binlog": "mysql-bin.000002"}]
    return raw_df(spark, ev)


def test_scenario01_rows(spark):
    raw = scenario01(spark)
    ch = build_changes(raw, bucket_size=4).orderBy("position", "row_idx").collect()
    got = [(r.table, r.event, r.data, r.old, r.changed, r.columns) for r in ch]
    cust = [x for x in got if x[0] == "binlogtest.customers"]
    assert cust == [
        ("binlogtest.customers", "EXT_WRITE_ROWS", '{"id":1,"name":"Alice","email":"alice@example.com"}', None, None,
         '["id","name","email"]'),
        ("binlogtest.customers", "EXT_WRITE_ROWS", '{"id":2,"name":"Bob","email":"bob@example.com"}', None, None,
         '["id","name","email"]'),
        ("binlogtest.customers", "EXT_UPDATE_ROWS", '{"id":1,"name":"Alice","email":"alice+new@example.com"}',
         '{"id":1,"name":"Alice","email":"alice@example.com"}',
         '{"email":{"old":"alice@example.com","new":"alice+new@example.com"}}', '["email"]'),
    ]
    items = [x for x in got if x[0] == "binlogtest.items"]
    assert [x[1] for x in items] == ["EXT_WRITE_ROWS"] * 3 + ["EXT_UPDATE_ROWS", "EXT_DELETE_ROWS"]
    assert items[0][2] == '{"id":1,"sku":"sku-0001","qty":10,"created_at":"2026-04-28T22:14:01.000+00:00"}'
    assert items[3][4] == '{"qty":{"old":10,"new":11}}'
    assert items[4][2] == items[4][3]  # delete: data is the deleted row
    assert items[4][4] is None and items[4][5] == '["id","sku","qty","created_at"]'
    # same GTID / offset for all rows of one event; counter runs per file
    assert [r.counter for r in ch] == list(range(1, 9))
    assert {r.gtid for r in ch if r.table == "binlogtest.items" and r.event == "EXT_WRITE_ROWS"} == {f"{UUID}:4"}


def test_scenario01_stats(spark):
    raw = scenario01(spark)
    ch = build_changes(raw)
    ops = {r.table_key: (r.writes, r.updates, r.deletes, r.total) for r in stats.table_op_counts(ch).collect()}
    assert ops == {"binlogtest.customers": (2, 1, 0, 3), "binlogtest.items": (3, 1, 1, 5)}
    cnt = {r.event_type: r.reference_count for r in stats.event_type_counts(raw).collect()}
    assert cnt["EXT_WRITE_ROWS"] == 7 and cnt["EXT_UPDATE_ROWS"] == 4 and cnt["EXT_DELETE_ROWS"] == 2
    fs = stats.file_summary(raw).collect()[0]
    assert fs.merged_gtids == f"{UUID}:1-7"
    assert fs.next_binlog == "mysql-bin.000002" and fs.file_server_id == 1


def test_scenario02_same_txn(spark):
    cols = ["id", "balance"]
    ev = [{"t": "FORMAT_DESCRIPTION"}]
    ev += txn(1, 7, "binlogtest", "accounts", cols, "EXT_WRITE_ROWS",
              [(None, ["1", "100.00"]), (None, ["2", "50.00"])], "INSERT INTO accounts (id, balance) VALUES (1, 100.00), (2, 50.00)")
    ev += [
        {"t": "GTID", "gtid": f"{UUID}:2"}, {"t": "QUERY"},
        {"t": "ROWS_QUERY", "query": "UPDATE accounts SET balance = balance - 25.00 WHERE id = 1"},
        {"t": "TABLE_MAP", "table_id": 7, "db": "binlogtest", "tbl": "accounts", "cols": cols},
        {"t": "EXT_UPDATE_ROWS", "table_id": 7, "rows": [(["1", "100.00"], ["1", "75.00"])]},
        {"t": "ROWS_QUERY", "query": "UPDATE accounts SET balance = balance + 25.00 WHERE id = 2"},
        {"t": "TABLE_MAP", "table_id": 7, "db": "binlogtest", "tbl": "accounts", "cols": cols},
        {"t": "EXT_UPDATE_ROWS", "table_id": 7, "rows": [(["2", "50.00"], ["2", "75.00"])]},
        {"t": "XID"},
    ]
    ch = build_changes(raw_df(spark, ev)).where("event = 'EXT_UPDATE_ROWS'").orderBy("position").collect()
    assert [r.changed for r in ch] == ['{"balance":{"old":100.00,"new":75.00}}', '{"balance":{"old":50.00,"new":75.00}}']
    assert ch[0].gtid == ch[1].gtid == f"{UUID}:2" and ch[0].gtid_position == ch[1].gtid_position
    assert ch[0].query != ch[1].query


def test_scenario03_nulls_and_types(spark):
    cols = ["id", "name", "value", "flag", "payload", "captured_at"]
    rows = [
        (None, ["1", '"metric_a"', "1.5", "1", '{"k":1}', '"2024-01-01T00:00:00.000+00:00"']),
        (None, ["2", '"metric_b"', "2.25", "0", "[1,2,3]", '"2024-01-01T00:00:01.500+00:00"']),
        (None, ["3", '"metric_c"', None, "1", None, '"2024-01-01T00:00:02.250+00:00"']),
    ]
    ev = txn(1, 3, "binlogtest", "metrics", cols, "EXT_WRITE_ROWS", rows, "INSERT ...")
    ev += txn(2, 3, "binlogtest", "metrics", cols, "EXT_UPDATE_ROWS",
              [(rows[1][1], ["2", '"metric_b"', "9.99", "0", "[1,2,3]", '"2024-01-01T00:00:01.500+00:00"'])], "UPDATE ...")
    ch = build_changes(raw_df(spark, ev)).orderBy("position", "row_idx").collect()
    assert ch[2].data == '{"id":3,"name":"metric_c","value":null,"flag":1,"payload":null,"captured_at":"2024-01-01T00:00:02.250+00:00"}'
    assert ch[3].changed == '{"value":{"old":2.25,"new":9.99}}' and ch[3].columns == '["value"]'
    assert ch[0].row_idx == 0 and ch[2].row_idx == 2 and ch[0].position == ch[2].position
