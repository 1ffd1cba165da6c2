import os

import pytest


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = root


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) as a table with columns that clash with inner names."""
    def make(rows):
        rows = [(i, t, "x", 1, b"y") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, _text string, _id int, `a b` binary")
    return make
