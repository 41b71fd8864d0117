"""The registered queries of the training-data operators."""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlog.llm import (
    ann, bpe, conversations, decontaminate, line_dedup, near_dups, repeats, secrets, simhash, token_counts, toxicity, urls, whitening,
)
from rowlog.llm.common import table

TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "")


def tokenizer_path(name: str) -> str:
    """A tokenizer file: in $TOKENIZER_DIR, else where the installed package has it."""
    if TOKENIZER_DIR:
        return os.path.join(TOKENIZER_DIR, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.scores(docs, model))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.digest(token_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digest(bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json")))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.cleaned(table(spark, sf_dir, "documents")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(*whitening.whiten(table(spark, sf_dir, "embeddings")))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    reports = conversations.report(rows, "dropped")
    return conversations.digest(reports, conversations.repaired(rows, reports, "dropped"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_url_filters": op3_url_filters,
    "op4_secrets": op4_secrets,
    "op5_nearest": op5_nearest,
    "op6_bpe": op6_bpe,
    "op7_repeats": op7_repeats,
    "op8_near_dups": op8_near_dups,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_conversations": op12_conversations,
    "op13_simhash": op13_simhash,
}


def oracle_sql() -> dict[str, str]:
    from rowlog.llm.oracle import SQL

    return dict(SQL)
