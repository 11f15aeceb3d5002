import datetime as dt

import pytest
from pyspark.sql import functions as F

from entiledger.functions import columns as C
from entiledger.operators import versions

from .conftest import rows

DAY = dt.datetime(2020, 1, 1)
SCHEMA = (
    "log_id long, n_id long, action string, created_ts timestamp_ntz, "
    "created_by string, status string, name string"
)


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [
            (1, 10, "create", DAY, "a", "draft", "x"),
            (2, 11, "create", DAY, "a", "production", "y"),
            (3, 10, "modify", DAY, "b", "production", "x2"),
            (4, 10, "delete", DAY, "b", "draft", "x3"),
            (5, 11, "modify", DAY - dt.timedelta(1), "b", "stage", "y2"),
        ],
        SCHEMA,
    )


def ids(df):
    return [r.log_id for r in df.collect()]


def test_latest_keeps_deleted_and_orders_by_time(log):
    assert ids(versions.query_log(log, latest=True)) == [5, 4]


def test_filter_comes_before_latest(log):
    assert ids(versions.query_log(log, status="production", latest=True)) == [2, 3]


def test_filters_combine(log):
    assert ids(versions.query_log(log, "production", "modify", 10)) == [3]
    assert ids(versions.query_log(log)) == [5, 1, 2, 3, 4]


def test_unknown_words_are_errors(log):
    with pytest.raises(ValueError):
        versions.filter_log(log, status="final")
    with pytest.raises(ValueError):
        versions.filter_log(log, action="drop")


def test_newest_and_last_names(log):
    assert rows(versions.newest_ids(log)) == [(10, 4, DAY), (11, 5, DAY)]
    assert rows(versions.last_names(log)) == [(10, "x3"), (11, "y2")]


def test_latest_cuts_before_the_shuffle(log):
    plan = versions.newest_per_entity(log)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark, log, tmp_path):
    log.write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    query = versions.query_log(stored, "draft", "create", 10, latest=True)
    plan = query._jdf.queryExecution().executedPlan().toString()
    for pushed in ("EqualTo(status,draft)", "EqualTo(action,create)", "EqualTo(n_id,10)"):
        assert pushed in plan
    assert ids(query) == [1]


@pytest.mark.parametrize("size", ["-1", "10m"])
def test_amplify(broadcast_up_to, log, size):
    broadcast_up_to(size)
    made = versions.amplify(log, 14)
    assert made.columns == log.columns
    assert made.count() == 70
    assert made.select("log_id").distinct().count() == 70
    assert made.agg(F.min("log_id")).first()[0] == 6
    of_first = made.where("n_id = 10 AND created_by = 'a'").orderBy("log_id").collect()
    assert [r.name for r in of_first] == [f"x3-{i}" for i in range(14)]
    assert [r.created_ts for r in of_first] == [
        DAY + dt.timedelta(i + 1) for i in range(14)
    ]
    status = [r.status for r in of_first]
    assert status[0] == "production" and status[13] == "production"
    assert status[5] == "stage" and status[10] == "stage"
    assert set(status[1:5]) == {"draft"}
    assert {r.action for r in of_first} == {"modify"}


def test_amplify_with_own_names(log):
    made = versions.amplify(log, 2, own_name=True, keep_status=True)
    assert rows(made.where("n_id = 11"), "name", "status") == [
        ("y-0", "production"),
        ("y-1", "production"),
        ("y2-0", "stage"),
        ("y2-1", "stage"),
    ]


def test_amplify_by_nothing(log):
    assert versions.amplify(log, 0).count() == 0


def test_enumeration_codes(spark):
    df = spark.createDataFrame([("stage", 3), ("other", 9), (None, None)], "t string, c int")
    got = df.select(
        C.status_code(F.col("t")), C.status_name(F.col("c")), C.action_name(F.col("c"))
    )
    assert [tuple(r) for r in got.collect()] == [
        (2, "production", "delete"),
        (None, None, None),
        (None, None, None),
    ]


def test_wall_clock_follows_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2020-01-01 05:00:00+03:00' AS t")
    assert df.select(C.wall_clock(F.col("t"))).first()[0] == dt.datetime(2020, 1, 1, 2)


def test_table_names(spark):
    df = spark.createDataFrame(
        [("ontology.map_artist", "map", None)], "n string, a string, v string"
    )
    got = df.select(
        C.bare_table_name(F.col("n")),
        C.bare_table_name(F.lit("plain")),
        C.table_name(F.lit("artist"), F.col("a"), F.col("v")),
    )
    assert tuple(got.first()) == ("map_artist", "plain", "map_artist")


def test_amplify_keeps_log_ids_dense(log):
    sparse = log.withColumn("log_id", F.col("log_id") * 2**33)
    high = 5 * 2**33
    made = versions.amplify(sparse, 3, own_name=True)
    assert rows(made, "log_id") == [(high + 1 + k,) for k in range(15)]
    places = made.orderBy("log_id").limit(5)
    assert rows(places, "n_id") == rows(log, "n_id")
