from pathlib import Path

import pytest
from pyspark.sql import functions as F

from entiledger.operators import load
from entiledger.operators.load import load_rows, load_series
from entiledger.sources.files import read_load_series

from .conftest import rows


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(
        [(1000, "brand"), (1001, "brand"), (1002, "company")], "n_id long, thing string"
    )


def new(spark, *names):
    return spark.createDataFrame(
        [(place, name) for place, name in enumerate(names)], "row_no int, name string"
    )


def changes(spark, *ids):
    return spark.createDataFrame(
        [(place, n_id, f"c{n_id}") for place, n_id in enumerate(ids)],
        "row_no int, n_id int, name string",
    )


def test_create(spark, registry):
    got = load_rows(new(spark, "x", "y"), registry, "brand", "row_no", first_log_id=7)
    assert rows(got.rows, "log_id", "n_id", "action", "name") == [
        (7, 1003, "create", "x"), (8, 1004, "create", "y"),
    ]
    assert rows(got.new_things) == [(1003, "brand"), (1004, "brand")]
    assert got.errors.count() == 0


def test_create_in_an_empty_registry(spark, registry):
    got = load_rows(new(spark, "x"), registry.where("n_id < 0"), "brand", "row_no")
    assert rows(got.rows, "n_id") == [(1000,)]


def test_modify(spark, registry):
    got = load_rows(changes(spark, 1001, 1000, 1001), registry, "brand", "row_no")
    assert rows(got.rows, "row_no", "n_id", "action") == [
        (0, 1001, "modify"), (1, 1000, "modify"), (2, 1001, "modify"),
    ]
    assert got.new_things.count() == 0


def test_one_bad_id_rejects_the_whole_batch(spark, registry):
    for ids, problem in (
        ((1000, 1002), "wrong_thing"),
        ((1000, 55), "unknown"),
        ((1000, None), "missing"),
    ):
        got = load_rows(changes(spark, *ids), registry, "brand", "row_no")
        assert got.rows.count() == 0
        assert rows(got.errors, "problem", "n_rows") == [(problem, 1)]


def test_errors_count_rows_per_id(spark, registry):
    got = load_rows(changes(spark, 1002, 1002, 9, 1000), registry, "brand", "row_no")
    assert rows(got.errors) == [
        (1, 9, None, "unknown", 1), (1, 1002, "company", "wrong_thing", 2),
    ]


def test_series(spark, registry):
    batches = [
        new(spark, "x", "y"),
        changes(spark, 1002),
        changes(spark, 1003, 1000),
        new(spark, "z"),
        changes(spark, 1005),
    ]
    got = load_series(batches, registry, "brand", "row_no", first_log_id=1)
    assert rows(got.rows, "batch_no", "log_id", "n_id", "action", "name") == [
        (1, 1, 1003, "create", "x"),
        (1, 2, 1004, "create", "y"),
        (3, 4, 1003, "modify", "c1003"),
        (3, 5, 1000, "modify", "c1000"),
        (4, 6, 1005, "create", "z"),
        (5, 7, 1005, "modify", "c1005"),
    ]
    assert rows(got.errors, "batch_no", "n_id") == [(2, 1002)]
    assert rows(got.new_things, "n_id") == [(1003,), (1004,), (1005,)]


def test_a_batch_does_not_know_later_ids(spark, registry):
    batches = [changes(spark, 1003), new(spark, "x")]
    got = load_series(batches, registry, "brand", "row_no")
    assert rows(got.errors, "batch_no", "problem") == [(1, "unknown")]
    assert rows(got.rows, "batch_no", "n_id") == [(2, 1003)]


def test_a_status_outside_the_enumeration_rejects_a_batch(spark, registry):
    ddl = "row_no int, name string, status string"
    good = spark.createDataFrame([(0, "x", "draft"), (1, "y", None)], ddl)
    bad = spark.createDataFrame([(0, "x", "draft"), (1, "y", "nonsense")], ddl)
    changed = spark.createDataFrame([(0, 1003, "z", "stage")], "row_no int, n_id int, name string, status string")
    got = load_series([bad, good, changed], registry, "brand", "row_no", first_log_id=1)
    assert rows(got.errors) == [(1, None, "nonsense", "status", 1)]
    assert rows(got.rows, "batch_no", "log_id", "n_id") == [
        (2, 3, 1003), (2, 4, 1004), (3, 5, 1003),
    ]
    assert rows(got.new_things, "n_id") == [(1003,), (1004,)]


def test_rows_without_a_number(spark, registry):
    batch = new(spark, "x").withColumn("row_no", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="row_no"):
        load_rows(batch, registry, "brand", "row_no")


def test_nothing_is_left(spark, registry):
    got = load_series([changes(spark, 9)], registry, "brand", "row_no", first_log_id=1)
    assert got.rows.count() == 0
    assert "log_id" in got.rows.columns


def test_a_plan_stays_when_the_registry_grows(spark, registry, tmp_path):
    path = str(tmp_path / "registry")
    registry.write.parquet(path)
    batches = [changes(spark, 1003), new(spark, "x")]
    stored = spark.read.parquet(path)
    got = load_series(batches, stored, "brand", "row_no", first_log_id=1)
    before = rows(got.rows, "batch_no", "n_id"), rows(got.errors)
    got.new_things.write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert spark.read.parquet(path).count() == 4
    assert (rows(got.rows, "batch_no", "n_id"), rows(got.errors)) == before


def test_scans_of_a_series_do_not_grow_with_its_batches(spark, tmp_path):
    registry = spark.createDataFrame([(1, "brand")], "n_id long, thing string")

    def plan(count):
        paths = []
        for place in range(count):
            paths.append(str(tmp_path / f"{count}-{place}.json"))
            Path(paths[-1]).write_text(f'{{"n_id": 1, "name": "n{place}"}}\n' * 2)
        rows = read_load_series(spark, paths, "n_id long, name string", "json", "place")
        series = load.Series(rows, [False] * count)
        done = load.load_series(series, registry, "brand", "place", first_log_id=5)
        assert [(r.batch_no, r.name, r.log_id) for r in done.rows.orderBy("log_id").collect()] == [
            (1 + k // 2, f"n{k // 2}", 5 + k) for k in range(2 * count)
        ]
        return done.rows._jdf.queryExecution().optimizedPlan().toString().count("json")

    assert plan(2) == plan(12)
