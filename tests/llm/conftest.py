from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm_helpers import AWKWARD, CLASHING, DOCS, FOLDER  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and further columns with the operators' own names."""
    docs = spark.createDataFrame(AWKWARD, DOCS)
    for name in CLASHING:
        docs = docs.withColumn(name, docs["n_chars"].cast("string"))
    return docs


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
