"""Newest versions kept beside a change log."""

import random

import pytest

from entiledger.operators.versions import query_log
from entiledger.plans import jobs, newest
from entiledger.sources.tables import append_rows, create_tables

from .conftest import rows
from .test_migrate import SPECS, legacy  # noqa: F401

COLUMNS = "log_id long, n_id long, action string, status string, name string"
FILTERS = [{}, {"status": "stage"}, {"n_id": 4, "action": "modify"}]


@pytest.fixture
def log(spark, request):
    database = f"kept_{request.node.name.split('[')[0]}"
    create_tables(spark, database, SPECS)
    return database


def made(spark, seed, first, n):
    """Rows with ids from a first one; entities, states and actions may be missing."""
    choose = random.Random(seed)
    found = [
        (
            first + k,
            choose.choice([1, 2, 3, 4, 4, 4, None]),
            choose.choice(["create", "modify", "delete", None]),
            choose.choice(["draft", "stage", "production", None]),
            f"{seed}-{k}",
        )
        for k in range(n)
    ]
    return spark.createDataFrame(found, COLUMNS)


def same(spark, database):
    whole = spark.table(f"{database}.company")
    kept = newest.newest_rows(spark, database, "company")
    for chosen in FILTERS:
        want = query_log(whole, latest=True, ordered=False, **chosen)
        got = query_log(kept, latest=True, ordered=False, **chosen)
        assert rows(got) == rows(want), chosen


def add(spark, database, part):
    append_rows(part, f"{database}.company")


def test_equals_the_log_after_appends(spark, log):
    jobs.keep_newest(spark, log, "company")
    same(spark, log)
    for k in range(3):
        add(spark, log, made(spark, k, 1 + 40 * k, 40))
        if k != 1:
            jobs.add_newest(spark, log, "company")
        same(spark, log)
    state = spark.table(f"{log}.company_newest")
    assert state.count() < 120
    jobs.add_newest(spark, log, "company")
    assert spark.table(f"{log}.newest_upto").count() == 2


def test_only_rows_above_the_watermark_are_read(spark, log):
    add(spark, log, made(spark, 1, 1, 30))
    jobs.keep_newest(spark, log, "company")
    found = newest.newest_rows(spark, log, "company")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(log_id,30)" in plan


def test_folding_drops_what_was_overtaken(spark, log, monkeypatch):
    monkeypatch.setattr(newest, "FOLD_AFTER", 2)
    jobs.keep_newest(spark, log, "company")
    sizes = []
    for k in range(4):
        part = spark.createDataFrame([(k + 1, 1, "modify", "draft", f"v{k}")], COLUMNS)
        add(spark, log, part)
        jobs.add_newest(spark, log, "company")
        sizes.append(spark.table(f"{log}.company_newest").count())
    same(spark, log)
    assert sizes == [1, 1, 2, 1]


def test_stops_in_between_change_no_answer(spark, log):
    add(spark, log, made(spark, 1, 1, 30))
    jobs.keep_newest(spark, log, "company")
    add(spark, log, made(spark, 2, 31, 30))
    # Half of an addition was written, and no watermark after it.
    part = spark.table(f"{log}.company").where("log_id > 45")
    append_rows(newest.newest_per_entity(part, newest.GROUP), f"{log}.company_newest")
    jobs.add_newest(spark, log, "company")
    same(spark, log)
    # A fold dropped the state before the new one took its name.
    spark.sql(f"ALTER TABLE {log}.company_newest RENAME TO {log}.company_newest_next")
    same(spark, log)
    add(spark, log, made(spark, 3, 61, 30))
    jobs.add_newest(spark, log, "company")
    assert spark.catalog.tableExists(f"{log}.company_newest")
    same(spark, log)


def test_replayed_rows_below_the_watermark(spark, log):
    add(spark, log, made(spark, 1, 100, 10))
    jobs.keep_newest(spark, log, "company")
    late = spark.createDataFrame([(50, 9, "create", "draft", "late")], COLUMNS)
    add(spark, log, late)
    jobs.add_newest(spark, log, "company", late)
    same(spark, log)


def test_jobs_keep_it_up(spark, log, legacy):  # noqa: F811
    names = (["brand", "company"], ["ios", "tapir"])
    jobs.keep_newest(spark, log, "company")
    jobs.fill(legacy, spark, log, SPECS, *names)
    known = spark.table(f"{log}.company").select("n_id").first()[0]
    batch = spark.createDataFrame(
        [(0, known, "one", "stage"), (1, known, "two", "draft")],
        "row_no int, n_id long, name string, status string",
    )
    for _ in range(2):
        jobs.load(spark, log, "company", [batch], "row_no", "t1")
    jobs.add_versions(spark, log, "company", 3)
    same(spark, log)
    done = spark.table(f"{log}.newest_upto").where("table_name = 'company'")
    last = spark.table(f"{log}.company").agg({"log_id": "max"}).first()[0]
    assert done.agg({"log_id": "max"}).first()[0] == last


def test_a_remap_takes_it_anew(spark, log, legacy):  # noqa: F811
    names = (["brand", "company"], ["ios", "tapir"])
    jobs.fill(legacy, spark, log, SPECS, *names)
    spec = next(s for s in SPECS if s.name == "brand")
    jobs.keep_newest(spark, log, "brand")
    jobs.store_foreign_keys(spark, log, spec, SPECS)
    got = jobs.query(spark, log, "brand", latest=True)
    assert rows(got) == rows(query_log(spark.table(f"{log}.brand"), latest=True))
    assert spark.table(f"{log}.brand_newest").columns == spark.table(f"{log}.brand").columns
