from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def texts(sf_dir):
    """doc_id -> text of the smallest documents table."""
    duckdb = pytest.importorskip("duckdb")
    return dict(
        duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    )


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names may clash."""

    def make(pairs):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "words string, fp string, label string, key string, ids string, token string"
        )
        rows = [
            (i, t, "en", "s", None if t is None else len(t), *["x"] * 6)
            for i, t in pairs
        ]
        return spark.createDataFrame(rows, schema)

    return make
