"""Paths, hand-built raw events and transactions that several test modules use."""
from rowlog.schema import RAW_SCHEMA

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"


def raw_df(spark, events, server_id=1, binarylog="mysql-bin.000001", start_ts=1_777_414_441_000):
    """Build raw events from compact dicts: {t: type, ...fields}; seq and
    next_position are assigned in list order (100 bytes per event)."""
    rows = []
    for i, e in enumerate(events):
        rows.append(
            (
                e.get("server_id", server_id),
                e.get("binarylog", binarylog),
                e.get("seq", i),
                e.get("next_position", 4 + 100 * (i + 1)),
                e["t"],
                e.get("timestamp", start_ts + i),
                e.get("gtid"),
                e.get("previous_gtids"),
                e.get("next_binlog"),
                e.get("query"),
                e.get("table_id"),
                e.get("db"),
                e.get("tbl"),
                e.get("cols"),
                [{"before": r[0], "after": r[1]} for r in e["rows"]] if "rows" in e else None,
            )
        )
    return spark.createDataFrame(rows, RAW_SCHEMA)


def txn(n, table_id, db, tbl, cols, etype, rows, query):
    return [
        {"t": "GTID", "gtid": f"{UUID}:{n}"},
        {"t": "QUERY"},
        {"t": "ROWS_QUERY", "query": query},
        {"t": "TABLE_MAP", "table_id": table_id, "db": db, "tbl": tbl, "cols": cols},
        {"t": etype, "table_id": table_id, "rows": rows},
        {"t": "XID"},
    ]
