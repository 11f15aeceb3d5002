"""Every registered query against its SQL on the smallest given tables."""

import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from entiledger.plans.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def test_keys_match():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, SF_DIR)
    want = sql.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    kinds = {c[0]: str(c[1]) for c in want.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == kinds
    expected = sorted(tuple(map(plain, row)) for row in want.fetchall())
    actual = sorted(tuple(map(plain, row)) for row in got.select(*names).collect())
    assert actual == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
