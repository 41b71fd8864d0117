"""The registered queries: their columns, whole tables, and their SQL."""
import duckdb
import pytest

import __spark_entry__ as entry
from rowlog.llm import queries

SF = "/root/testdata/sf0.001"
# The columns that each query must return.
COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_url_filters": "page_id host path rule verdict",
    "op4_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_nearest": "query_id rank vec_id score",
    "op6_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_near_dups": "doc_id n_shingles component_id kept",
    "op9_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op10_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_conversations": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_simhash": "doc_id fingerprint component_id",
}


def test_every_operator_is_registered():
    assert set(COLUMNS) == set(queries.QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries() and set(queries.oracle_sql()) <= set(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_rows_and_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    got = df.toPandas()
    sizes = {"page_id": ("pages", 1), "doc_id": ("documents", 1), "conv_id": ("conversations", 1), "vec_id": ("embeddings", 32), "query_id": ("embeddings", 0.1)}
    key = df.columns[0]
    table, times = sizes[key]
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    assert len(got) == times * (rows.select(key).distinct() if key == "conv_id" else rows).count()
    if (sql := entry.oracle_sql().get(name)) is None:
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(sql).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    rows = [sorted(map(tuple, x[cols].astype(str).to_numpy().tolist())) for x in (got, want)]
    assert rows[0] == rows[1]
