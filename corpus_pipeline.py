"""The corpus pipeline: documents to token ids, in five stages.

Every stage takes all rows that its predecessor kept and, but for the last,
returns the columns of `documents`. Stages are written as Parquet and read
again, so a lost executor costs no more than part of one stage.

1. toxicity: documents that the classifier scores 0.5 or more go.
2. line dedup: a line of 40 or more characters that stands in 5 or more
   documents stays in the one with the largest id; n_chars follows the text.
3. MinHash near-dedup: of each group of documents linked at a similarity of
   0.8 over five-word shingles, the one with the smallest id stays. Rows with
   the same doc_id are one document.
4. benchmark decontamination: documents that hold a 10-word window of a
   benchmark item (or a shorter item whole) go.
5. BPE coding: doc_id, n_tokens, ids, decoded.

Null and empty texts pass all stages, an empty table gives an empty result,
and further columns are carried along.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.llm import bpe, decontaminate, line_dedup, near_dups, toxicity
from rowlog.llm.common import boxed, landed, table, unboxed
from rowlog.llm.queries import tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_lines(docs, length_col="n_chars")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_dups.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    rows = boxed(docs, "doc_id").join(gone.hint("merge"), F.col("x0") == F.col("doc_id"), "left_anti")
    return unboxed(rows, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", bpe.ids().alias("ids"), "decoded")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

# Fitting a classifier and near-duplicate components are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
