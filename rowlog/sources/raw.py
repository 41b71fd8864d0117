"""Reading the decoded event table and the change lake."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowlog.functions.text import padded_seq
from rowlog.schema import ALLOWED_EVENT_TYPES, RAW_SCHEMA


def raw_events(
    spark: SparkSession, path: str, fmt: str = "parquet", with_file_size: bool = False, with_log_size: bool = False,
) -> DataFrame:
    """Scan a decoded event table with the fixed input schema (no inference).

    with_file_size adds `file_size`: the size of the event-table file each row
    came from (from the scan's hidden metadata column). with_log_size adds
    `log_size`: the size of the original log, which the decoder may land with
    its events; null where the table lacks the column.
    """
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("log_size", T.LongType())]) if with_log_size else RAW_SCHEMA
    df = spark.read.schema(schema).format(fmt).load(path)
    if with_file_size:
        df = df.select(*schema.names, F.col("_metadata.file_size").alias("file_size"))
    return df


def assert_event_types(raw: DataFrame, allowed=ALLOWED_EVENT_TYPES, on_error: str = "fail"):
    """Gate on the event type.

    "fail": `event_type` is rewritten so that any value outside `allowed`
    raises when the column is evaluated; downstream operators all read it.
    "quarantine": returns (accepted, rejected) DataFrames instead.
    """
    ok = F.col("event_type").isin(*allowed)
    if on_error == "quarantine":
        return raw.where(ok), raw.where(~ok | F.col("event_type").isNull())
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    gated = F.when(ok, F.col("event_type")).otherwise(
        F.raise_error(F.concat(F.lit("Unexpected event type: "), F.coalesce(F.col("event_type"), F.lit("null"))))
    )
    return raw.withColumn("event_type", gated)


def read_changes(spark: SparkSession, root: str, table: str | None = None, tables=None, by_file: bool = False) -> DataFrame:
    """Scan the change lake. `table` (a `db.t` name) or `tables` select exactly
    these, and only their directories are listed and read."""
    from rowlog.sinks.parquet import read_lake

    return read_lake(spark, root, by_file, [table] if table is not None else tables)


def closed_files(listing: DataFrame, current: DataFrame, name_col: str = "binarylog", keys=()) -> DataFrame:
    """All listed logs except the active one(s), in log order.

    `listing` has one row per log file name (e.g. from SHOW BINARY LOGS),
    `current` the active file name(s), both optionally per `keys` (e.g.
    server_id). Ordered by the zero-padded sequence so `x.10` sorts after `x.9`."""
    on = [*keys, name_col]
    closed = listing.join(current.select(*on), on, "left_anti")
    return closed.withColumn("log_seq", padded_seq(name_col)).orderBy(*keys, "log_seq", name_col)
