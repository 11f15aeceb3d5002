"""Legacy tables and change logs as views of the given tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiledger.functions.columns import table_name
from entiledger.model import ACTIONS, LEGACY_PREFIX, ColumnSpec, TableSpec

# When and by whom tables without log columns were written.
WRITTEN_TS = "1998-08-02 00:00:00"
WRITTEN_BY = "import"

# Entity types of the legacy views, in migration order, and their vendors.
LEGACY_THINGS = ["nation", "customer", "orders", "part", "warehouse"]
LEGACY_VENDORS = ["supplier", "segment", "activity", "line"]
LEGACY_ACTIONS = list(ACTIONS)

SPECS = [
    TableSpec("nation", (ColumnSpec("region_id", "int", "region"),)),
    TableSpec(
        "customer",
        (
            ColumnSpec("nation_id", "int", "nation"),
            ColumnSpec("balance", "double"),
            ColumnSpec("nick_name", "string30"),
        ),
        ("activity",),
    ),
    TableSpec(
        "orders",
        (ColumnSpec("customer_id", "int", "customer"), ColumnSpec("total", "double")),
        ("line",),
    ),
    TableSpec("part", (ColumnSpec("brand", "string30"),), ("supplier",)),
]


# Columns of the given tables that are bound here; stating them saves reading every
# file footer before a query starts.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, "
    "n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for the files of a query, in the shared checkpoint folder.

    Only a local session that names none gets a folder of its own; on a cluster one that
    its machines share must be named.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    shared = shared or tempfile.mkdtemp(prefix="scratch-")
    return f"{shared}/{uuid.uuid4().hex}"


def new_database(spark: SparkSession) -> str:
    """A new database whose tables lie in a scratch folder."""
    name = f"ledger_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark)}'")
    return name


def _written() -> Column:
    return F.lit(WRITTEN_TS).cast("timestamp_ntz")


def _logs(ts: Column, by: Column) -> list[Column]:
    return [
        ts.alias("created_ts"),
        by.alias("created_by"),
        ts.alias("updated_ts"),
        by.alias("updated_by"),
    ]


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the change log of their users."""
    kind, value = F.col("event_type"), F.col("value")
    action = (
        F.when(kind == "signup", "create").when(kind == "error", "delete")
    ).otherwise("modify")
    status = F.when(value < 20, "draft").when(value < 60, "stage")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("n_id"),
        action.alias("action"),
        F.col("ts").alias("created_ts"),
        kind.alias("created_by"),
        status.otherwise("production").alias("status"),
        F.col("props").alias("name"),
        "value",
    )


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_id"),
        *_logs(_written(), F.lit(WRITTEN_BY)),
    )


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"),
        *_logs(_written(), F.col("c_mktsegment")),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orders_id"),
        F.col("o_orderstatus").alias("orders_name"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        *_logs(F.col("o_orderdate"), F.col("o_orderpriority")),
    )


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        *_logs(_written(), F.col("p_type")),
    )


def _import_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_name").alias("part"), "p_size")


def _map_part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").cast("string").alias("ext_id"),
        *_logs(F.col("l_shipdate"), F.col("l_returnflag")),
    )


def _import_part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")


def _map_orders_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orders_id"),
        F.concat_ws("-", "l_partkey", "l_linenumber").alias("ext_id"),
        *_logs(F.col("l_shipdate"), F.col("l_returnflag")),
    )


def _map_customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("props").alias("ext_id"),
        *_logs(F.col("ts"), F.col("event_type")),
    )


def _map_customer_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )


# Entity, map and import tables under the legacy naming rules.
LEGACY_TABLES = {
    "nation": _nation,
    "customer": _customer,
    "orders": _orders,
    "part": _part,
    "import_part": _import_part,
    "map_part_supplier": _map_part_supplier,
    "import_part_supplier": _import_part_supplier,
    "map_orders_line": _map_orders_line,
    "map_customer_activity": _map_customer_activity,
    "map_customer_segment": _map_customer_segment,
}


def legacy_tables(
    spark: SparkSession, sf_dir: str, *names: str
) -> dict[str, DataFrame]:
    """The named legacy tables, or all of them."""
    chosen = names or LEGACY_TABLES
    return {name: LEGACY_TABLES[name](spark, sf_dir) for name in chosen}


def legacy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One legacy table."""
    return LEGACY_TABLES[name](spark, sf_dir)


def small_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy table of the parts; those over size 40 under ids that no map row has."""
    part_id = F.when(F.col("p_size") > 40, -F.col("p_partkey"))
    return read(spark, sf_dir, "part").select(
        F.coalesce(part_id, "p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"),
        *_logs(_written(), F.col("p_type")),
    )


def sound_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, those in debt under keys that no order has."""
    debt = F.when(F.col("c_acctbal") < 0, -F.col("c_custkey"))
    return read(spark, sf_dir, "customer").withColumn(
        "c_custkey", F.coalesce(debt, "c_custkey")
    )


def customer_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge of the customers, without the old ids of those in debt."""
    return sound_customers(spark, sf_dir).select(
        F.col("c_custkey").alias("old_id"),
        F.lit("customer").alias("thing"),
        (F.col("c_custkey") + 1_000_000_000).alias("n_id"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an entity log with a foreign key to customers."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("log_id"),
        F.col("o_orderkey").alias("n_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
    )


def region_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region, nation and segment as category levels."""
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    return (
        read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("row_no"),
            F.col("c_name").alias("level_0"),
            F.col("r_name").alias("level_1"),
            F.col("n_name").alias("level_2"),
            F.col("r_name").alias("level_3"),
            F.col("c_mktsegment").alias("level_4"),
            F.col("c_mktsegment").alias("level_5"),
        )
    )


LEVELS = [f"level_{k}" for k in range(6)]


def activity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table names that the users' activity implies: segment, action, nation."""
    customers = read(spark, sf_dir, "customer")
    nations = read(spark, sf_dir, "nation")
    seen = (
        read(spark, sf_dir, "events")
        .groupBy("event_type", "user_id")
        .count()
        .join(customers, F.col("user_id") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    thing, action = F.lower("c_mktsegment"), F.col("event_type")
    vendor, none = F.lower("n_name"), F.lit(None).cast("string")
    names = F.array(
        table_name(thing, none, none),
        table_name(thing, action, none),
        table_name(thing, action, vendor),
    )
    bare = seen.select(F.explode(names).alias("name")).distinct()
    return bare.select(F.concat(F.lit(LEGACY_PREFIX), "name").alias("table_name"))


ACTIVITY_THINGS = ["building", "automobile", "machinery", "household", "aircraft"]
ACTIVITY_VENDORS = [f"nation_{n}" for n in range(25)]
ACTIVITY_ACTIONS = ["purchase", "view", "error"]


def market_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog with a table per nation and a column per segment sold there."""
    nations = read(spark, sf_dir, "nation")
    sold = read(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    table, segment = F.col("n_name"), F.col("c_mktsegment")
    columns = F.array(
        F.concat(table, F.lit("_id")),
        F.concat(table, F.lit("_name")),
        table,
        F.lit("created_ts"),
        F.lit("updated_by"),
        F.concat(table, F.lit("_code")),
        segment,
    )
    return (
        sold.groupBy("n_name", "c_mktsegment")
        .count()
        .select(
            F.concat(F.lit(LEGACY_PREFIX), table).alias("table_name"),
            F.explode(columns).alias("column_name"),
            F.lit("string").alias("data_type"),
        )
        .distinct()
    )


def market_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns: the segments with a well-funded customer in the nation."""
    nations = read(spark, sf_dir, "nation")
    funded = F.when(F.col("c_acctbal") > 8000, F.col("c_mktsegment"))
    return (
        read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("table_name"), funded.alias("column_name"))
        .distinct()
    )


def typed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of the activity's tables; how busy a table is decides its types."""
    customers = read(spark, sf_dir, "customer")
    nations = read(spark, sf_dir, "nation")
    seen = (
        read(spark, sf_dir, "events")
        .join(customers, F.col("user_id") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.lower("c_mktsegment").alias("thing"),
            rule_action(F.col("event_type")).alias("action"),
            F.lower("n_name").alias("vendor"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    thing, action = F.col("thing"), F.col("action")
    vendor, none = F.col("vendor"), F.lit(None).cast("string")
    names = F.array(
        table_name(thing, none, none),
        table_name(thing, action, none),
        table_name(thing, action, vendor),
    )
    sized = (
        seen.select("thing", F.explode(names).alias("table_name"), "n")
        .groupBy("thing", "table_name")
        .agg(F.sum("n").alias("n"))
    )
    n = F.col("n")

    def column(name: Column, test: Column, kind: str, other: str) -> Column:
        return F.struct(
            name.alias("column_name"), F.when(test, kind).otherwise(other).alias("data_type")
        )

    columns = F.array(
        column(F.concat("thing", F.lit("_id")), n % 3 > 0, "bigint", "double"),
        column(F.concat("thing", F.lit("_name")), n % 2 > 0, "varchar(200)", "int"),
        column(F.lit("ext_id"), n % 4 > 0, "string", "int"),
        column(F.lit("created_ts"), n % 5 > 0, "timestamp_ntz", "string"),
        column(F.lit("updated_ts"), n % 7 > 0, "timestamp", "date"),
        column(F.lit("created_by"), F.lit(True), "string", "string"),
        column(F.lit("updated_by"), n % 11 > 0, "string", "binary"),
    )
    return sized.select(
        F.concat(F.lit(LEGACY_PREFIX), "table_name").alias("table_name"),
        F.inline(columns),
    )


def rule_action(event_type: Column) -> Column:
    """Legacy action of an event, so that every column rule meets some tables."""
    return (
        F.when(event_type == "purchase", "map")
        .when(event_type == "view", "fuzzymatch")
        .when(event_type == "error", "import")
        .otherwise("exp")
    )


def column_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sheet of declared columns, a row per part, with blanks."""
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey")).alias("table"),
        F.col("p_brand").alias("c1"),
        F.when(F.col("p_size") < 5, "").otherwise("string30").alias("t1"),
        F.when(F.col("p_retailprice") >= 950, F.col("p_type")).alias("c2"),
        F.lit("string200").alias("t2"),
        F.lit("size").alias("c3"),
        F.lit("int").alias("t3"),
        F.col("p_name").alias("c4"),
    )


def vendor_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sheet of vendors, a row per part, with blanks; small parts have none."""
    large, dear = F.col("p_size") >= 10, F.col("p_retailprice") > 975
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey")).alias("table"),
        F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("").alias("v1"),
        F.when(large & dear, F.col("p_name")).alias("v2"),
        F.when(large, F.col("p_type")).alias("v3"),
    )
