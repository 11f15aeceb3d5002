"""Queries with SQL against DuckDB, on the smallest given tables."""

from pathlib import Path

import pytest

from entiledger.llm import queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = con.execute(queries.SQL[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    actual = sorted(repr(tuple(r)) for r in got.select(*names).collect())
    assert actual == sorted(repr(r) for r in want.fetchall())


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
