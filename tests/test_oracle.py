"""Registered queries against their DuckDB oracle on the smallest tables."""
import duckdb
import pytest
from helpers import SF

import __spark_entry__ as entry

TABLES = ["orders", "lineitem", "customer", "events"]
NAMES = ["row_changes", "txn_tagging", "table_map_resolution", "captured_transactions", "file_summary",
         "merge_gtids", "multi_row_explode", "state_at", "bootstrap", "delete_storms", "redacted_changes",
         "padded_names", "gtid_parse", "transitions_decimal", "transitions_null", "row_history_moves", "redacted_query",
         "lake_table_exact", "convert_job", "merge_gtids_fragmented", "fingerprint_cases", "co_changed_txn",
         "lake_two_bases", "empty_lake", "stream_rate_append", "stream_split_log", "lake_versions", "file_sizes",
         "empty_row_events", "single_ordered", "typed_images", "key_lookup"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(pdf):
    import math

    import pandas as pd

    def n(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float) and v.is_integer():
            return str(int(v))
        return str(v)
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(n(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
