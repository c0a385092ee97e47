"""Fixtures and inputs that the tests of the training-data operators share."""

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows]


def odd_rows(passage: str):
    """Nulls, empty and white texts, repeated rows and ids, a long text; in the order of (id, text)."""
    return [(None, None), (None, passage), (None, passage), (1, None), (1, ""), (1, passage), (2, " \n\t "),
            (3, passage + " tail"), (3, passage + " tail"), (4, "short"), (5, ("word " * 5000) + passage)]


def odd_frame(spark, passage: str):
    """The odd rows with columns whose names clash with those that operators make."""
    rows = [(*r, k, "x", 1.5) for k, r in enumerate(odd_rows(passage))]
    return spark.createDataFrame(rows, "doc_id long, text string, key int, rid string, n_tokens double")
