"""Scalar helpers against the edge cases of the reference's string handling."""
from decimal import Decimal

from pyspark.sql import functions as F

from rowlog.functions import fingerprint, gtid_txn, gtid_uuid, output_name, padded_seq, parse_long, table_key
from rowlog.functions.images import change_col, image_col, typed_image
from rowlog.functions.text import table_key_of
from rowlog.functions.time import parse_time_text, utc_millis, utc_seconds


def col(spark, values, f, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {t}")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_gtid_parts(spark):
    g = ["u:7", "u:", ":7", "u", "", "u:1:2", "u: 7", None]
    assert col(spark, g, gtid_uuid) == ["u", "u", None, None, None, "u", "u", None]
    assert col(spark, g, gtid_txn) == [7, None, 7, None, None, None, None, None]


def test_parse_long(spark):
    assert col(spark, ["12", "+5", "-3", " 1 ", "1.0", "99999999999999999999", "", None], parse_long) == [
        12, 5, -3, None, None, None, None, None]


def test_padded_seq_and_output_name(spark):
    names = ["mysql-bin.42", "x", "x.", "a.b.000007", "m.12345678901", "01-basic-crud.binlog"]
    assert col(spark, names, padded_seq) == ["0000000042", "0000000000", "0000000000", "0000000007", "12345678901",
                                             "0000000000"]
    assert col(spark, names[:2], lambda c: output_name(c, F.lit(3))) == ["mysql-bin.3.0000000042", "x.3.0000000000"]


def test_table_key(spark):
    assert col(spark, ["db.t", "a b.c/d", "", None, "\t "], table_key) == [
        "db.t", "a_b.c_d", "unknown_table", "unknown_table", "unknown_table"]


def test_times(spark):
    assert col(spark, [1777414441000], utc_seconds, "long") == ["2026-04-28 22:14:01"]
    assert col(spark, [1777414441123, None], utc_millis, "long") == ["2026-04-28 22:14:01.123", None]
    assert col(spark, ["1777414441000", "2026-04-28 22:14:01", "nope"], parse_time_text) == [
        1777414441000, 1777414441000, None]


def test_fingerprint(spark):
    q = [
        "INSERT INTO t (a, b) VALUES (1, 'x'), (2, 'it''s')",
        "UPDATE t1 SET v = -5 WHERE id IN (1, 2, 3) -- trailing",
        "/* c */ SELECT * FROM t2 WHERE h = 0xFF AND s = \"q\"",
    ]
    assert col(spark, q, fingerprint) == [
        "INSERT INTO t (a, b) VALUES (?, ?)",
        "UPDATE t1 SET v = ? WHERE id IN (...)",
        "SELECT * FROM t2 WHERE h = ? AND s = ?",
    ]


def test_with_fingerprint_distinct_equals_expr(spark):
    from rowlog.operators.workload import with_fingerprint

    df = spark.createDataFrame(
        [(1, "INSERT INTO t VALUES (1, 'a'), (2, 'b')"), (2, "UPDATE t SET v = 5 WHERE id IN (1, 2, 3)"),
         (3, None), (4, "INSERT INTO t VALUES (7, 'c')")],
        "id long, query string",
    )
    a = sorted(tuple(r) for r in with_fingerprint(df, "expr").collect())
    b = sorted(tuple(r) for r in with_fingerprint(df, "distinct").select(*df.columns, "query_fingerprint", "query_hash").collect())
    assert a == b
    assert a[0][2] == a[3][2] == "INSERT INTO t VALUES (?, ?)"
    assert a[2][2] is None and a[2][3] is None


def test_fingerprint_reads_left_to_right(spark):
    q = [
        "INSERT INTO t VALUES ('/*','x','*/')",
        "UPDATE t SET a=5--3 WHERE id=1",
        "UPDATE t SET a = 1 -- don't\n, b = 'x' WHERE id = 2",
        "UPDATE `it's` SET a = 'q'",
        "UPDATE t SET a = .5, b = X'0F', c = 1.5e-3",
        r"UPDATE t SET a = 'it\'s', b = '\\' WHERE id = 3",
        "SELECT a1, 1a, é2 FROM t # it's",
    ]
    assert col(spark, q, fingerprint) == [
        "INSERT INTO t VALUES (?, ?, ?)",
        "UPDATE t SET a=?--? WHERE id=?",
        "UPDATE t SET a = ?, b = ? WHERE id = ?",
        "UPDATE `it's` SET a = ?",
        "UPDATE t SET a = ?, b = ?, c = ?",
        "UPDATE t SET a = ?, b = ? WHERE id = ?",
        "SELECT a1, 1a, é2 FROM t",
    ]


def test_fingerprint_of_very_long_statements(spark):
    rows = "INSERT INTO t VALUES " + ", ".join(f"({i}, 'v{i}', -1)" for i in range(50_000))
    escapes = "UPDATE t SET a = '" + "\\'" * 50_000 + "x' WHERE id = 9"
    doubled = "UPDATE t SET a = '" + "''" * 50_000 + "x' WHERE id = 9"
    assert col(spark, [rows, escapes, doubled], fingerprint) == [
        "INSERT INTO t VALUES (?, ?, ?)", "UPDATE t SET a = ? WHERE id = ?", "UPDATE t SET a = ? WHERE id = ?"]


def test_image_values_are_exact(spark):
    image = '{"a":100.00,"b.c":null,"d":true,"e\\"f":"x\\"y","n":"12.50","s":"{,\\"a\\":7"}'
    names = ["a", "b.c", "d", 'e"f', "n", "zz"]
    got = [col(spark, [image], lambda c, n=n: image_col(c, n))[0] for n in names]
    assert got == ["100.00", None, "true", 'x"y', "12.50", None]
    assert col(spark, [image], lambda c: image_col(c, "a", "decimal(10,2)"))[0] == Decimal("100.00")
    diff = '{"a":{"old":100.00,"new":75.00},"b.c":{"old":null,"new":"1"},"d":{"old":"x","new":2.50}}'
    want = {("a", "old"): "100.00", ("a", "new"): "75.00", ("b.c", "old"): None, ("b.c", "new"): "1", ("d", "old"): "x", ("d", "new"): "2.50"}
    assert {k: col(spark, [diff], lambda c, k=k: change_col(c, *k))[0] for k in want} == want


def test_typed_images(spark):
    df = spark.sql("SELECT struct(1 AS id, timestamp '2026-04-28 22:14:01' AS t, X'00FF' AS b, CAST(NULL AS string) AS n) AS s")
    assert df.select(typed_image("s")).first()[0] == '{"id":1,"t":"2026-04-28T22:14:01.000+00:00","b":"AP8=","n":null}'


def test_literal_table_keys(spark):
    names = ["db.t", "a b.c/d", "", None, "\t ", "schéma.t"]
    assert [table_key_of(n) for n in names] == col(spark, names, table_key)
