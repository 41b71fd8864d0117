"""Sinks: the per-table change lake, a single ordered output, the output
audit and the statistics tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.functions.text import file_base, padded_seq, table_key, table_key_of
from rowlog.schema import CHANGE_COLUMNS, CHANGE_SCHEMA
from rowlog.session import INTERMEDIATE, scratch_path, written
from rowlog.sinks import manifest

# The reference writer's Parquet settings.
REFERENCE_PROFILE = {
    "compression": "snappy",
    "parquet.block.size": str(16 * 1024 * 1024),
    "parquet.page.size": str(512 * 1024),
    "parquet.writer.version": "PARQUET_2_0",
}


def lake_frame(changes: DataFrame, by_file: bool = False) -> DataFrame:
    """The 18 output columns plus partition columns (`table_key`, and with
    by_file `log_base` and `log_seq`; `server_id` is an output column already)."""
    extra = [table_key("table").alias("table_key")]
    if by_file:
        extra += [file_base("binarylog").alias("log_base"), padded_seq("binarylog").alias("log_seq")]
    keep = [c for c in ("row_idx",) if c in changes.columns]
    return changes.select(*CHANGE_COLUMNS, *keep, *extra)


def write_by_table(
    changes: DataFrame,
    root: str,
    by_file: bool = False,
    replace: str | None = None,
    profile: dict | None = None,
) -> str:
    """One Parquet dataset per sanitized table name under `root`.

    Rows are rebalanced on the partition columns (AQE splits a hot table over
    several tasks and merges small ones) and sorted within each task in
    partition and log order, so each file holds one partition in log order.
    by_file partitions by (log_base, server_id, log_seq, table_key), the whole
    identity of a log, so many servers and logs share one root; the files
    become visible as one snapshot (see `sinks.manifest`).

    replace="all" replaces everything under the root; "touched" (by_file)
    replaces only the logs being written, all their tables included (a re-run
    of a log is idempotent even if it yields fewer tables). The default is
    "touched" for a shared root (by_file), else "all". `root/_schema` is an
    empty dataset with the schema, so an empty output can be read, too."""
    if by_file:
        write_logs(changes, root, replace or "touched", profile)
        return root
    if replace not in (None, "all"):
        raise ValueError("without by_file, replace must be 'all'")
    _writer(_in_log_order(lake_frame(changes), ["table_key"]), ["table_key"], profile).mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(root)
    _keep_schema(changes, root, by_file)
    return root


def write_logs(changes: DataFrame, root: str, replace: str = "touched", profile: dict | None = None) -> str:
    """Write the logs of `changes` as a new generation and commit it as the
    next snapshot of the lake; returns the generation."""
    if replace not in ("all", "touched"):
        raise ValueError("replace must be 'all' or 'touched'")
    spark, generation = changes.sparkSession, manifest.new_generation()
    parts = ["generation", *manifest.LOG, "table_key"]
    df = lake_frame(changes, by_file=True).withColumn("generation", F.lit(generation))
    # No reader sees the folder before the commit, so each task may move its own
    # files there; else the driver moves them, one log after the other.
    w = _writer(_in_log_order(df, parts[1:]), parts, profile).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    w.mode("append").parquet(root)
    _keep_schema(changes, root, by_file=True)
    manifest.commit(spark, root, generation, replace)
    return generation


def _in_log_order(df: DataFrame, parts: list[str]) -> DataFrame:
    idx = ["row_idx"] if "row_idx" in df.columns else []
    df = df.hint("rebalance", *parts).withColumn("_ls", padded_seq("binarylog"))
    return df.sortWithinPartitions(*parts, "server_id", "_ls", "binarylog", "position", *idx).drop("_ls")


def _writer(df: DataFrame, parts: list[str], profile: dict | None):
    w = df.write.partitionBy(*parts)
    for k, v in (profile or REFERENCE_PROFILE).items():
        w = w.option(k, v)
    return w


def _keep_schema(changes: DataFrame, root: str, by_file: bool) -> None:
    path = f"{root.rstrip('/')}/_schema"
    if not manifest.exists(changes.sparkSession, path):
        changes.sparkSession.createDataFrame([], lake_schema(by_file)).write.mode("overwrite").parquet(path)


def write_single(changes: DataFrame, path: str, files: int | None = None) -> str:
    """All tables in one dataset, globally ordered by log order.

    A range-partitioned sort writes part files whose name order is log order.
    It reads its rows twice, first to find the ranges, so the changes are made
    and written before it. files=1 gives the single-file form: the sorted parts are written first, and
    one task copies them in order, row by row, without a sort of its own."""
    df = lake_frame(changes).drop("table_key")
    df = df.withColumn("_ls", padded_seq("binarylog"))
    keys = ["server_id", "_ls", "binarylog", "position"] + (["row_idx"] if "row_idx" in df.columns else [])
    df = written(df, "unsorted").orderBy(*keys).drop("_ls")
    if files == 1:
        df = _in_one_task(df)
    w = df.write.mode("overwrite")
    for k, v in REFERENCE_PROFILE.items():
        w = w.option(k, v)
    w.parquet(path)
    return path


def _in_one_task(ordered: DataFrame) -> DataFrame:
    """The rows of an ordered frame as one partition that is read, not sorted:
    the parts are written and scanned one after the other, by name."""
    spark, path = ordered.sparkSession, scratch_path(ordered.sparkSession, "sorted")
    ordered.write.options(**INTERMEDIATE).parquet(path)
    parts = [n for n in manifest.names(spark, path) if n.startswith("part-")]
    rows = spark.createDataFrame([], ordered.schema)
    for i, name in enumerate(parts):
        part = spark.read.schema(ordered.schema).parquet(f"{path}/{name}")
        rows = part if i == 0 else rows.unionByName(part)
    return rows.coalesce(1)


def lake_schema(by_file: bool = False):
    """Explicit read schema: partition values keep their text (no type
    inference turning `0000000008` into 8)."""
    from pyspark.sql import types as T

    schema = T.StructType(list(CHANGE_SCHEMA.fields))
    schema = schema.add("row_idx", T.IntegerType())
    if by_file:
        schema = schema.add("log_base", T.StringType()).add("log_seq", T.StringType())
    return schema.add("table_key", T.StringType())


def read_lake(spark: SparkSession, root: str, by_file: bool = False, tables=None, version: int | None = None) -> DataFrame:
    """Read a change lake, an empty one too; `tables` (db.table names) prune
    partition directories and match exactly. A lake by_file is read as its
    newest snapshot, or as `version`: only the folders of live files are listed."""
    schema = lake_schema(by_file)
    if not by_file:
        df = spark.read.schema(schema).parquet(root)
    else:
        files = manifest.live(spark, root, version)
        if tables:
            files = files.where(F.col("table_key").isin([table_key_of(t) for t in tables]))
        df = read_files(spark, root, files)
    if tables:
        from rowlog.operators.protect import filter_tables

        df = filter_tables(df, allow=list(tables))
    return df


def read_files(spark: SparkSession, root: str, files: DataFrame, whole_folders: bool = True) -> DataFrame:
    """The rows of listed files. With whole_folders, all files of the folders
    they are in, which one write made; else these files only."""
    found = manifest.paths(root, files, whole_folders)
    schema = lake_schema(by_file=True)
    df = spark.read.schema(schema).option("basePath", root).parquet(*(found or [f"{root.rstrip('/')}/_schema"]))
    return df.select(*schema.names)


def audit_output(spark: SparkSession, root: str, expected: DataFrame, by_file: bool = False) -> DataFrame:
    """Compare a written lake with expected row counts per table_key.

    Reports rows read back (by_file: as the snapshot's list has them, which is
    read back from the files), number of files, smallest file size, and flags:
    `ok` (counts match, every file non-empty) and `small_file` (< 100 bytes)."""
    if by_file:
        got = manifest.live(spark, root).groupBy("table_key").agg(
            F.sum("rows").alias("written_rows"), F.min("bytes").alias("min_file_size"))
    else:
        lake = spark.read.schema(lake_schema()).parquet(root).select("table_key", F.col("_metadata.file_size").alias("sz"))
        got = lake.groupBy("table_key").agg(F.count(F.lit(1)).alias("written_rows"), F.min("sz").alias("min_file_size"))
    return audited(expected, got).select(
        "table_key", "expected_rows", "written_rows",
        (F.col("ok") & (F.coalesce("min_file_size", F.lit(1)) > 0)).alias("ok"),
        F.coalesce(F.col("min_file_size") < 100, F.lit(False)).alias("small_file"),
    )


def audited(expected: DataFrame, got: DataFrame) -> DataFrame:
    """table_key, expected_rows, written_rows, ok, beside the further columns of `got`."""
    j = expected.join(got, "table_key", "full").withColumns({
        "expected_rows": F.coalesce("expected_rows", F.lit(0)).cast("long"), "written_rows": F.coalesce("written_rows", F.lit(0)).cast("long")})
    return j.withColumn("ok", F.col("expected_rows") == F.col("written_rows"))


def write_stats(root: str, **tables: DataFrame) -> str:
    """Write statistics DataFrames (event_type_counts=..., table_op_counts=...,
    file_summary=...) as small Parquet tables under root/_stats/<name>."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_stats/{name}")
    return root
