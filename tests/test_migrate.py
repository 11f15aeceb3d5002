import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from entiledger.model import ColumnSpec, TableSpec
from entiledger.operators import migrate

from .conftest import rows

NOW = dt.datetime(2021, 5, 1)
LOGS = "created_ts timestamp_ntz, created_by string, updated_ts timestamp_ntz, updated_by string"
STAMP = (NOW, "c", NOW, "u")


def table(spark, ddl, *data):
    return spark.createDataFrame([(*r, *STAMP) for r in data], f"{ddl}, {LOGS}")


@pytest.fixture(scope="module")
def legacy(spark):
    return {
        "brand": table(
            spark, "brand_id int, brand_name string, company_id int, junk int",
            (30, "b30", 2, 0), (10, "b10", 1, 0), (20, "b20", 8, 0),
        ),
        "company": table(spark, "company_id int, company string", (2, "c2"), (1, "c1")),
        "region": spark.createDataFrame([(1, "r")], "region_id int, region string"),
        "map_brand_ios": table(
            spark, "brand_id int, ext_id int", (10, 77), (10, 78), (99, 79)
        ),
        "map_brand_tapir": table(spark, "brand_id int, ext_id string", (30, "t")),
        "fuzzymatch_brand_ios": table(spark, "brand_id int, ext_id string", (10, "no")),
        "map_company_ios": table(spark, "company_id int, ext_id string", (2, "c")),
    }


SPECS = [
    TableSpec(
        "brand",
        (ColumnSpec("extra", "string30"), ColumnSpec("company_id", "int", "company")),
        ("ios", "tapir"),
    ),
    TableSpec("company", (), ("tapir",)),
]


def test_columns_are_found_in_table_order(spark):
    df = spark.createDataFrame([], "x int, brand string, brand_name string, brand_id int")
    assert migrate.name_column(df, "brand") == "brand"
    assert migrate.id_column(df, "brand") == "brand_id"
    with pytest.raises(ValueError, match="company"):
        migrate.name_column(df, "company")
    with pytest.raises(ValueError, match="company_id"):
        migrate.id_column(df, "company")


def test_missing_log_columns_name_the_table(legacy):
    with pytest.raises(ValueError, match="region.*updated_ts"):
        migrate.migrate_thing(legacy["region"], "region")


def test_migrate_thing(legacy):
    extras = migrate.extra_columns(legacy["brand"], SPECS[0])
    assert extras == ["company_id"]
    got = migrate.migrate_thing(legacy["brand"], "brand", 1000, extras)
    assert got.log.columns == [
        "log_id", "n_id", "action", "created_ts", "created_by", "status", "name",
        "company_id",
    ]
    assert rows(got.log) == [
        (1, 1000, "create", NOW, "u", "draft", "b10", 1),
        (2, 1001, "create", NOW, "u", "draft", "b20", 8),
        (3, 1002, "create", NOW, "u", "draft", "b30", 2),
    ]
    assert rows(got.bridge) == [
        (10, "brand", 1000), (20, "brand", 1001), (30, "brand", 1002),
    ]
    assert rows(got.registry) == [(1000, "brand"), (1001, "brand"), (1002, "brand")]


def test_empty_table_migrates_to_nothing(legacy):
    got = migrate.migrate_thing(legacy["brand"].where(F.lit(False)), "brand")
    assert got.log.count() == got.bridge.count() == got.registry.count() == 0


def test_first_by_rank_keeps_ties(spark):
    df = spark.createDataFrame([(k // 2,) for k in range(30)], "k int").repartition(5)
    got = migrate.first_by_rank(df, "k", 3)
    assert sorted(r.k for r in got.collect()) == [0, 0, 1, 1]
    assert migrate.first_by_rank(df, "k", 100).count() == 30
    assert migrate.first_by_rank(df.where("k < 0"), "k", 3).count() == 0


def test_join_drops_orphans_and_keeps_multiples(legacy):
    things = migrate.legacy_rows(legacy["brand"], "brand")
    maps = migrate.map_rows(legacy["map_brand_ios"], "brand", "map_brand_ios")
    got = migrate.join_thing_and_map(things, maps)
    assert rows(got, "old_id", "name", "ext_id") == [(10, "b10", "77"), (10, "b10", "78")]
    short = migrate.join_thing_and_map(things, maps, short_load=True)
    assert short.count() == 2
    lacking = migrate.unbridged(things, things.where("old_id > 15"))
    assert rows(lacking, "old_id") == [(10,)]


def test_vendor_ids(spark):
    registry = spark.createDataFrame(
        [(3, "ios", "main"), (5, "ios", "main"), (9, "tapir", "copy")],
        "v_id long, vendor string, database string",
    )
    wanted = spark.createDataFrame([("tapir", 0), ("ios", 1), ("app", 2)], "vendor string, o int")
    ids, added = migrate.assign_vendor_ids(registry, wanted, ["o"])
    assert rows(ids) == [("app", 11), ("ios", 3), ("tapir", 10)]
    assert rows(added) == [(10, "tapir", "main"), (11, "app", "main")]
    none = registry.where(F.lit(False))
    assert rows(migrate.assign_vendor_ids(none, wanted, ["o"])[0]) == [
        ("app", 3), ("ios", 2), ("tapir", 1),
    ]


@pytest.fixture(scope="module")
def plan(legacy):
    return migrate.migrate_all(
        legacy, SPECS, ["brand", "company", "ghost"], ["ios", "tapir"]
    )


def test_migrate_all(plan):
    assert plan.things == ["brand", "company"]
    assert rows(plan.bridge) == [
        (1, "company", 1003), (2, "company", 1004), (10, "brand", 1000),
        (20, "brand", 1001), (30, "brand", 1002),
    ]
    assert rows(plan.log("company"), "log_id", "n_id", "name") == [
        (1, 1003, "c1"), (2, 1004, "c2"),
    ]


def test_vendors_are_visited_last_first(spark, plan):
    assert plan.map_tables() == [
        ("brand", "tapir", "map_brand_tapir"),
        ("brand", "ios", "map_brand_ios"),
    ]
    empty = spark.createDataFrame([], "v_id long, vendor string, database string")
    ids, added = plan.vendor_ids(empty)
    assert rows(ids) == [("ios", 2), ("tapir", 1)]
    got = plan.name_map(ids)
    assert rows(got, "n_id", "v_id", "ext_id", "map_type", "confidence") == [
        (1000, 2, "77", "person", 1.0),
        (1000, 2, "78", "person", 1.0),
        (1002, 1, "t", "person", 1.0),
    ]


def test_each_thing_looks_its_new_ids_up_by_itself(spark, legacy, broadcast_up_to):
    broadcast_up_to(-1)
    spec = TableSpec("company", (), ("ios",))
    told = [(10, "brand", 1000), (30, "brand", 1002), (2, "company", 1004), (10, "company", 9)]
    bridge = spark.createDataFrame(told, "old_id long, thing string, n_id long")
    done = migrate.migrate_all(
        legacy, [SPECS[0], spec], ["brand", "company"], ["ios", "tapir"], bridge=bridge
    )
    vendors = spark.createDataFrame([("ios", 2), ("tapir", 1)], "vendor string, v_id long")
    got = done.name_map(vendors)
    assert rows(got, "n_id", "v_id", "ext_id") == [
        (1000, 2, "77"), (1000, 2, "78"), (1002, 1, "t"), (1004, 2, "c"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert any("_salt#" in k for k in keys)
    assert not any("thing#" in k for k in keys)


def test_entities_that_a_log_lacks_are_found_without_a_broadcast_of_ids(
    spark, legacy, broadcast_up_to, tmp_path
):
    broadcast_up_to("10m")
    told = [(10, "brand", 1000), (20, "brand", 1001), (30, "brand", 1002), (40, "brand", 1003)]
    bridge = spark.createDataFrame(told, "old_id long, thing string, n_id long")
    log = spark.createDataFrame([(7, 1001)], "log_id long, n_id long")
    files = {"brand": legacy["brand"], "bridge": bridge, "log": log}
    for name, df in files.items():
        df.write.parquet(f"{tmp_path}/{name}")
        files[name] = spark.read.parquet(f"{tmp_path}/{name}")
    done = migrate.migrate_all(files, SPECS, ["brand"], [], bridge=files["bridge"])
    ids = migrate.legacy_ids(files, ["brand"])
    got = done.lacking_log("brand", ids, files["log"], 8)
    assert rows(got, "log_id", "n_id", "name") == [(8, 1000, "b10"), (9, 1002, "b30")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Only the counts of the buckets are broadcast.
    keys = re.findall(r"BroadcastHashJoin \[(.*?)\]", plan)
    assert keys and all(k.startswith("_bucket#") for k in keys)
    assert re.search(r"SortMergeJoin .*LeftSemi", plan) and re.search(r"SortMergeJoin .*LeftAnti", plan)


def test_ids_that_a_bridge_lacks_are_found_without_a_broadcast(spark, broadcast_up_to):
    broadcast_up_to("10m")
    things = spark.createDataFrame([(10,), (20,), (None,)], "old_id long")
    got = migrate.unbridged(things, spark.createDataFrame([(20,), (30,)], "old_id long"))
    assert rows(got) == [(10,), (None,)]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_nothing_declared(legacy):
    with pytest.raises(ValueError, match="declared"):
        migrate.migrate_all(legacy, SPECS, ["ghost"], [])


def test_starts_of_things_are_counted_once(legacy):
    plan = migrate.migrate_all(legacy, SPECS, ["company", "brand"], [])
    log = plan.log("brand")
    assert rows(log, "log_id", "n_id") == [(1, 1002), (2, 1003), (3, 1004)]
    assert "scalar-subquery" not in log._jdf.queryExecution().analyzed().toString()
    assert plan._starts == {"company": 1000, "brand": 1002}
