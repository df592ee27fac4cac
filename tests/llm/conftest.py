"""Plain-Python counterparts and small tables for the operators' tests."""

import pytest

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    """``doc_id -> text`` of the small table."""
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def table(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make
