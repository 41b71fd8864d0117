"""Row events -> one output row per affected row (the `changes` table)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.functions.images import (
    all_columns,
    changed_columns,
    changed_index,
    quoted_names,
    row_diff,
    row_image,
)
from rowlog.functions.text import gtid_txn, gtid_uuid, qualified_table
from rowlog.functions.time import typed_instant

W, U, D = "EXT_WRITE_ROWS", "EXT_UPDATE_ROWS", "EXT_DELETE_ROWS"


def with_names(events: DataFrame) -> DataFrame:
    """Attach what the images of an event have in common (quoted keys, the
    all-columns list, the table): before its images are, so it is made once per
    event, not once per row."""
    return events.select(
        "*",
        quoted_names("column_names").alias("_qn"),
        all_columns("column_names").alias("_all"),
        qualified_table("db", "tbl").alias("_table"),
    )


def image_rows(ex: DataFrame, strict: bool = False) -> DataFrame:
    """The changes: one row per row image of each row event, numbered in event
    order (`row_idx`).

    `ex` are the images (`image`, `row_idx`) of row events carrying the
    sequencing columns, the resolved table map (db, tbl, column_names) and what
    `with_names` makes of it, and `last_query` (with query_fingerprint and
    query_hash, if wanted).
    """
    b, a = F.col("image.before"), F.col("image.after")
    et = F.col("event_type")
    if strict:
        check = F.when(
            (et == U) & (F.size(b) != F.size(a)),
            F.raise_error(F.lit("update row images differ in length")),
        )
        b = F.coalesce(check.cast("array<string>"), b)
    one = ex.withColumn("_idx", F.when(et == U, changed_index(b, a)))
    named = F.col("column_names").isNotNull()
    data = F.when(named, F.when(et == D, row_image("_qn", b)).otherwise(row_image("_qn", a)))
    old = F.when(named & et.isin(U, D), row_image("_qn", b))
    changed = F.when(named & (et == U), row_diff("_qn", b, a, "_idx"))
    columns = F.when(named, F.when(et == U, changed_columns("column_names", "_idx")).otherwise(F.col("_all")))
    g = F.col("txn_gtid")
    return one.select(
        F.col("binarylog"),
        F.col("position"),
        F.col("txn_position").alias("gtid_position"),
        g.alias("gtid"),
        gtid_uuid(g).alias("gtid_uuid"),
        gtid_txn(g).alias("gtid_txn"),
        F.col("server_id"),
        F.col("timestamp"),
        typed_instant("timestamp").alias("timestamp_string"),
        et.alias("event"),
        F.col("_table").alias("table"),
        F.col("last_query").alias("query"),
        *(F.col(c) if c in ex.columns else F.lit(None).cast("string").alias(c) for c in ("query_fingerprint", "query_hash")),
        data.alias("data"),
        old.alias("old"),
        changed.alias("changed"),
        columns.alias("columns"),
        F.col("row_idx").cast("int").alias("row_idx"),
        F.col("seq"),
        F.col("segment"),
        (F.col("rows_before") + F.col("row_idx") + 1).alias("counter"),
    )
