import datetime as dt

import pytest

from entiledger.model import ACTIONS, THINGS, VENDORS
from entiledger.operators import audit
from entiledger.plans.jobs import check, compare_schema
from entiledger.sources.catalog import CATALOG_TYPE, catalog_of

from .conftest import rows

NOW = dt.datetime(2020, 1, 1)
LOGS = "created_ts timestamp_ntz, created_by string, updated_ts timestamp, updated_by string"


def found(spark, names, *lists):
    lists = lists or (list(THINGS), list(VENDORS), list(ACTIONS))
    df = spark.createDataFrame([(n,) for n in names], "table_name string")
    got = audit.enumerate_tables(df, *lists)
    place = audit.report_position(got, len(lists[1]), len(lists[2]))
    return [r.table_name for r in got.orderBy(place).collect()]


def test_enumeration_order(spark):
    names = [
        "ontology.map_artist_tapir",
        "ontology.fuzzymatch_artist_cheetah",
        "ontology.import_artist",
        "ontology.map_artist_cheetah",
        "ontology.artist",
        "ontology.app",
        "ontology.map_app_stork_ios_android",
        "ontology.map_app_stork",
        "ontology.auth_user",
        "ontology.map_artist_unknown",
    ]
    assert found(spark, names) == [
        "app",
        "map_app_stork",
        "map_app_stork_ios_android",
        "artist",
        "import_artist",
        "map_artist_cheetah",
        "fuzzymatch_artist_cheetah",
        "map_artist_tapir",
    ]


def test_things_without_a_table_are_skipped(spark):
    names = ["ontology.education_level", "ontology.map_title_tapir", "theatre_title"]
    assert found(spark, names) == []


def test_one_name_may_belong_to_two_things(spark):
    names = ["team", "team_home", "map_team_home"]
    lists = (["team", "team_home"], ["home"], ["map"])
    assert found(spark, names, *lists) == [
        "team",
        "map_team_home",
        "team_home",
        "map_team_home",
    ]


@pytest.fixture(scope="module")
def legacy(spark):
    def table(ddl, *data):
        return spark.createDataFrame(list(data), ddl)

    return {
        "ontology.actor": table(
            f"actor_id int, actor string, {LOGS}", (1, "a", NOW, "u", NOW, "u")
        ),
        "ontology.import_actor": table("actor_name int"),
        "ontology.map_actor_platypus": table(
            f"actor_id int, ext_id string, {LOGS}",
            (1, "x", NOW, "u", NOW, "u"),
            (1, "y", NOW, "u", NOW, "u"),
            (2, "x", NOW, "u", NOW, "u"),
            (3, None, NOW, "u", NOW, "u"),
            (4, None, NOW, "u", NOW, "u"),
        ),
        "ontology.fuzzymatch_actor_platypus": table(f"actor_id int, ext_id int, {LOGS}"),
        "ontology.map_actor_tapir": table("actor_id int, tapir_id int", (1, 1)),
        "ontology.import_actor_tapir": table("actor_name string, extra int"),
        "ontology.history_actor_tapir": table("anything int", (1,)),
        "ontology.region": table(
            "region_id string, region_name string, created_ts date, spare int"
        ),
        "ontology.auth_user": table("id int", (1,)),
    }


def test_report(spark, legacy):
    got = check(legacy, spark)
    assert got.columns == [
        "table_name", "thing", "action", "vendor", "good_id", "good_name", "good_log",
        "columns", "rows", "dup id", "dup ext_id",
    ]
    p, t = "platypus", "tapir"
    assert [tuple(r) for r in got.collect()] == [
        ("actor", "actor", None, None, True, True, True, 6, 1, 0, 0),
        ("import_actor", "actor", "import", None, None, False, None, 1, 0, 0, 0),
        ("map_actor_platypus", "actor", "map", p, True, None, True, 6, 5, 1, 1),
        ("fuzzymatch_actor_platypus", "actor", "fuzzymatch", p, True, None, True, 6, 0, 0, 0),
        ("map_actor_tapir", "actor", "map", t, True, None, False, 2, 1, None, None),
        ("import_actor_tapir", "actor", "import", t, None, True, None, 2, 0, 0, 0),
        ("history_actor_tapir", "actor", "history", t, None, None, None, 1, 1, 0, 0),
        ("region", "region", None, None, False, True, False, 4, 0, 0, 0),
    ]


def test_empty_catalog_gives_an_empty_report(spark):
    names = spark.createDataFrame([], "table_name string")
    assert audit.enumerate_tables(names, ["a"], ["b"], ["c"]).count() == 0


def test_ext_column_check(spark, legacy):
    catalog = catalog_of(spark, legacy)
    listed = audit.enumerate_tables(
        catalog.select("table_name"), ["actor"], ["platypus", "tapir"], list(ACTIONS)
    )
    checks = audit.column_checks(listed, catalog)
    assert dict(rows(checks, "table_name", "good_ext")) == {
        "actor": None,
        "import_actor": None,
        "map_actor_platypus": True,
        "fuzzymatch_actor_platypus": False,
        "map_actor_tapir": False,
        "import_actor_tapir": None,
        "history_actor_tapir": None,
    }
    former = audit.column_checks(listed, catalog, ["ext"])
    assert former.where("good_ext").count() == 0


def test_wrong_type_falls_through_to_the_next_label(spark):
    catalog = spark.createDataFrame(
        [("t", 0, "t_name", "int"), ("t", 1, "t", "varchar(200)"), ("t", 2, "t_id", "string")],
        CATALOG_TYPE,
    )
    listed = audit.enumerate_tables(catalog.select("table_name"), ["t"], [], [])
    got = audit.column_checks(listed, catalog).first()
    assert (got.good_name, got.good_id, got.good_log, got.columns) == (True, False, False, 3)


def test_catalog_keeps_declared_lengths(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cat_test")
    spark.sql("CREATE TABLE cat_test.c (a VARCHAR(200), b BIGINT) USING parquet")
    got = catalog_of(spark, {"c": spark.table("cat_test.c")})
    assert rows(got) == [("c", 0, "a", "varchar(200)"), ("c", 1, "b", "bigint")]


def test_schema_difference(spark, legacy):
    declared = spark.createDataFrame(
        [("region", "spare"), ("actor", None), ("ghost", "x"), ("import_actor", "z")],
        "table_name string, column_name string",
    )
    assert compare_schema(legacy, spark, declared).count() == 1
    got = compare_schema(legacy, spark, declared).first()
    assert (got.table_name, got.column_name) == ("import_actor", "actor_name")
