"""Helpers shared by the training-data operators."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.session import scratch_path

# Arrow batches handed to Python workers: bounded by rows and by bytes, so a
# worker's memory does not depend on the size of its partition.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Session settings the Python-backed operators rely on."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut and a
    lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, whatever other columns there are:
    names that differ in case only are no clash."""
    places = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*places).select(*(F.col(places[df.columns.index(n)]).alias(n) for n in names))


def boxed(df: DataFrame, *names: str) -> DataFrame:
    """`row`, the whole input row as a struct whose fields are named by place
    (c0, c1, ..), and x0, x1, ..: the columns of exactly these names. No
    column of the input, whatever its name, can meet another one."""
    places = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*places).select(
        F.struct(*places).alias("row"), *(F.col(places[df.columns.index(n)]).alias(f"x{i}") for i, n in enumerate(names)))


def unboxed(rows: DataFrame, like: DataFrame, **new: Column) -> DataFrame:
    """The columns of `like` from `row`, in order and by their names; those in
    `new` have a new value."""
    each = [new.get(n, F.col("row").getField(f"c{i}")).alias(f"c{i}") for i, n in enumerate(like.columns)]
    return rows.select(*each).toDF(*like.columns)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; null text is empty."""
    return exact(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def texts(batch: pa.RecordBatch, i: int = 1) -> list[str]:
    return batch.column(i).to_pylist()
