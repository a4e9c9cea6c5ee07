from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return [(row.doc_id, row.text) for row in docs.orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, ties and columns with names of the operators."""
    long = "the long text goes on and on " * 20_000
    line = "a line of more than forty characters that is in all of them"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "b", 4), (4, "word", None, "a", 4),
            (None, "a text whose id is not known to anyone at all", "en", None, None), (6, long, "en", "b", len(long)),
            (7, "two rows of the same id and the same text are here now", "en", "a", 54),
            (7, "two rows of the same id and the same text are here now", "en", "a", 54),
            *[(10 + k, f"{line}\nits own {k}", "en", "c", 70) for k in range(6)]]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("kept", "copy", "node", "shard", "gone", "n_lines", "bucket", "repeats", "row_key", "size", "spans"):
        frame = frame.selectExpr("*", f"'given' AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
