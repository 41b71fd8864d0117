"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

`LineRuns` keeps, per line key (a 128-bit hash), the number of documents
that hold it and its keeper, the document in which it stays. Documents come
in batches, the largest ids first. A batch's keys are aggregated, joined
against the runs by a merge join, and written as a new run: keys that the
runs lack (the anti-join) get their keeper from this batch, keys that they
have only add to the count. Runs are Parquet tables bucketed and sorted by
the hash, so neither side of the merge is sorted or shuffled anew; `fanout`
runs of a level are compacted into one of the next.

Afterwards a line is dropped where its key is long enough, stands in enough
documents, and the document is not its keeper. Only hashes are shuffled for
that; a hot key is aggregated map-side, and the join that takes verdicts to
the lines may be split by adaptive execution.

A text's lines are looked up in the sorted array of the keys that its document
loses, by fences: with n keys a line costs about the root of n, so a text of
100,000 lines that all go is no quadratic work.

Edge cases: a null or empty text is one empty line and stays so; rows with
the same doc_id are one document in the counts, and each row is cleaned; a
null doc_id is cleaned of nothing and holds nothing; an empty table gives no
rows; further columns are carried along in a struct, whatever their names.
"""
from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowlog.llm.common import ascii_lower, boxed, exact, landed, unboxed
from rowlog.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]
RUN = T.StructType([
    T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
    T.StructField("n_docs", T.LongType()), T.StructField("keeper", T.LongType()),
])


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANKS))
    # An ASCII line may take the engine's fast lower-casing.
    return F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(ascii_lower(stripped))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """Distinct (doc_id, h1, h2) of the lines that are long enough."""
    rows = exact(docs, id_col, text_col)
    each = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.explode(lines_of(F.col(text_col))).alias("line")).where("doc_id is not null")
    keyed = each.select("doc_id", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_length)
    return keyed.select("doc_id", key_hash(F.col("key")).alias("h")).select("doc_id", "h.h1", "h.h2")


class LineRuns:
    """Levelled sorted runs of (h1, h2, n_docs, keeper). Used in a `with`
    statement, which leaves no table behind, whatever happens."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, max(2, fanout)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = defaultdict(list)
        self.paths: dict[str, str] = {}

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_) -> None:
        self._forget(list(self.paths))

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.paths[name] = scratch_path(self.spark, name)
        (run.select("h1", "h2", "n_docs", "keeper").repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.paths[name]).format("parquet").saveAsTable(name))
        return name

    def _all(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels.values() for n in level]

    def add(self, batch: DataFrame) -> None:
        """Take in (doc_id, h1, h2) rows of documents no earlier batch held;
        their ids are smaller than all ids taken in before."""
        own = batch.distinct().groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("newest"))
        for i, run in enumerate(self._all()):
            own = own.join(run.select(*KEY, F.lit(True).alias(f"in_{i}")), KEY, "left")
        seen = [F.col(f"in_{i}") for i in range(len(self._all()))]
        known = F.coalesce(*seen, F.lit(False)) if seen else F.lit(False)
        self.levels[0].append(self._write(own.select(*KEY, "n_docs", F.when(~known, F.col("newest")).alias("keeper"))))
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            self.levels[level + 1].append(self._write(self._merged(names)))
            self._forget(names)
            level += 1

    def _merged(self, names: list[str]) -> DataFrame:
        """The runs as one. Read as plain files: the union of bucketed scans
        is not bucketed, and only an exchange brings equal keys together."""
        out = self.spark.createDataFrame([], RUN)
        for n in names:
            out = out.unionByName(self.spark.read.schema(RUN).parquet(self.paths[n]))
        return out.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def _forget(self, names: list[str]) -> None:
        """Drop the tables; the files stay for those that read them as such."""
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")

    def state(self) -> DataFrame:
        """Every key once, with its number of documents and its keeper."""
        names = [n for level in self.levels.values() for n in level]
        state = self._merged(names)
        self._forget(names)
        return state


def dropped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """doc_id -> the keys (array of hash pairs) of the lines it loses."""
    spark = docs.sparkSession
    ids = exact(docs, id_col).select(F.col(id_col).cast("long").alias("id"))
    cuts = ids.select(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] or []
    number = sum((F.col("doc_id") <= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    found = line_hashes(docs, id_col, text_col, min_length).withColumn("batch", F.lit(0) + number)
    path = scratch_path(spark, "lines")
    found.write.partitionBy("batch").parquet(path)
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc_id", "h1", "h2")), T.StructField("batch", T.IntegerType())])
    lines = spark.read.schema(schema).parquet(path)
    with LineRuns(spark, fanout) as runs:
        for b in range(len(cuts) + 1):  # batch 0 holds the largest ids
            runs.add(lines.where(F.col("batch") == b).select("doc_id", *KEY))
        # Landed, so that adaptive execution can split the join on a common line.
        common = landed(runs.state().where(F.col("n_docs") >= min_docs).select(*KEY, "keeper"), "common-lines")
    losing = lines.select("doc_id", *KEY).join(common, KEY).where(F.col("doc_id") != F.col("keeper"))
    return losing.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct(*KEY))).alias("lost"))


FEW = 64


def _among(keys: Column, fences: Column, key: Column) -> Column:
    """Whether a sorted array has the key. `fences` are its elements 0, s,
    2s, ..: the key can only be among the s elements from its last fence on."""
    step = F.ceil(F.sqrt(F.size(keys))).cast("int")
    block = F.size(F.filter(fences, lambda f: f <= key))
    return F.when(F.size(keys) <= FEW, F.array_contains(keys, key)).otherwise(
        (block > 0) & F.array_contains(F.slice(keys, F.greatest(block - 1, F.lit(0)) * step + 1, step), key))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """row (the input row, see `common.boxed`), doc_id, text (cleaned; a null
    text that loses nothing stays null), n_lines (before), n_dropped."""
    lost = landed(dropped(docs, id_col, text_col, **how), "lost").withColumnRenamed("doc_id", "of")
    # A merge at every size, so that the cost on little data tells that on much.
    rows = boxed(docs, id_col, text_col).join(lost.hint("merge"), F.col("x0").cast("long") == F.col("of"), "left")
    step = F.ceil(F.sqrt(F.size("lost"))).cast("int")
    rows = rows.withColumn("fences", F.filter("lost", lambda x, i: i % step == 0))
    lines = lines_of(F.col("x1"))
    # A short line shares no key with a long one, so its hash is never among the lost.
    each = F.transform(lines, lambda x: F.struct(x.alias("line"), key_hash(line_key(x)).alias("key")))  # a key is taken once
    kept = F.transform(F.filter(each, lambda x: ~_among(F.col("lost"), F.col("fences"), x["key"])), lambda x: x["line"])
    rows = rows.select("row", "x0", "x1", F.size(lines).cast("long").alias("n_lines"), F.when(F.col("lost").isNotNull(), kept).alias("kept"))
    return rows.select(
        "row", F.col("x0").alias("doc_id"), F.when(F.col("kept").isNull(), F.col("x1")).otherwise(F.array_join("kept", "\n")).alias("text"),
        "n_lines", F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0).cast("long")).alias("n_dropped"))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, **how) -> DataFrame:
    """The documents, all their columns, with text_col cleaned. `length_col`
    names a column that holds the text's length: it follows the text."""
    done = cleaned(docs, id_col, text_col, **how)
    new = {text_col: F.col("text")}
    if length_col:
        was = F.col("row").getField(f"c{docs.columns.index(length_col)}")
        new[length_col] = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema[length_col].dataType)).otherwise(was)
    return unboxed(done, docs, **new)


def digest(done: DataFrame) -> DataFrame:
    """Of the rows of `cleaned`."""
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
