import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from cases import TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", None if i == 5 else f"src{i % 3}", None if t is None else len(t), i) for i, t in TEXTS]
    # Extra columns whose names clash with outputs.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
