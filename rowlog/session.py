"""Session helpers: a tuned local session for tests/bench, shared-folder paths, written intermediates."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every rowlog job relies on. UTC keeps formatted times stable; the
# timestamp type makes `timestamp_string` a millisecond, UTC-adjusted column.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings of the engine's jobs. Shuffles begin with many partitions, which AQE
# merges to its advisory size, and scans are cut small (event rows are some
# twenty times their Parquet size), so a task's share stays the same as the
# input grows. A join takes rows that are dealt by some of its keys as they are.
# A lake has a folder for each log: folders are listed by a few tasks that take
# many each, where Spark would start one for each, up to 10,000 a level.
SPLIT = str(16 * 1024 * 1024)
ENGINE_CONF = {
    "spark.sql.files.maxPartitionBytes": SPLIT,
    "spark.sql.files.openCostInBytes": str(512 * 1024),  # a lake has many small files
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
}


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "rowlog") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession, engine: bool = True) -> None:
    """Apply the runtime SQL settings rowlog needs to an existing session,
    those of the engine's own jobs (or, without `engine`, take them back)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    for k, v in ENGINE_CONF.items():
        if engine:
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) == v:
            spark.conf.unset(k)
    shared_dir(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Read from the session. Only a local master may go without it (tests): a
    scratch folder is made and registered. On a cluster a machine-local folder
    would be out of the executors' reach, so an unset folder is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"spark.checkpoint.dir is not set on master {sc.master}")
        d = tempfile.mkdtemp(prefix="rowlog-ckpt-", dir=os.environ.get("ROWLOG_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediates, under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/rowlog-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location in the run folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediates. For when results are written:
    DataFrames that were returned before read some of them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Intermediates: row groups no larger than a scan's split.
INTERMEDIATE = {"compression": "zstd", "parquet.block.size": SPLIT}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back with its schema: one
    computation for many readers, and lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**INTERMEDIATE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
