"""Operators bound to the given tables, each with equivalent SQL to check it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiledger.functions import columns as C
from entiledger.model import LEGACY_PREFIX, entity_columns, struct_type
from entiledger.operators import audit, hierarchy, keys, load, migrate, schema, versions
from entiledger.operators.ids import dense_ids, next_id
from entiledger.plans import bindings as B
from entiledger.plans import jobs
from entiledger.sources import files
from entiledger.sources.catalog import catalog_of
from entiledger.sources.tables import aligned, append_rows, create_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query together with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        SQL[name] = sql
        return function

    return register


EVENTS_LOG = """
  ev AS (SELECT event_id AS log_id, user_id AS n_id,
           CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete'
                ELSE 'modify' END AS action,
           ts AS created_ts, event_type AS created_by,
           CASE WHEN value < 20 THEN 'draft' WHEN value < 60 THEN 'stage'
                ELSE 'production' END AS status,
           props AS name, value
         FROM events)"""

# --- versions ---------------------------------------------------------------


@query(
    "latest_versions",
    f"""WITH {EVENTS_LOG}
    SELECT ev.* FROM ev
    JOIN (SELECT max(log_id) AS m FROM ev GROUP BY n_id) ON m = log_id""",
)
def latest_versions(spark, sf_dir):
    return versions.query_log(B.events_log(spark, sf_dir), latest=True)


@query(
    "latest_filtered",
    f"""WITH {EVENTS_LOG}
    SELECT ev.* FROM ev
    JOIN (SELECT max(log_id) AS m FROM ev
          WHERE status = 'production' AND action = 'modify' GROUP BY n_id)
      ON m = log_id""",
)
def latest_filtered(spark, sf_dir):
    log = B.events_log(spark, sf_dir)
    return versions.query_log(log, "production", "modify", latest=True)


@query(
    "history_by_action",
    f"WITH {EVENTS_LOG} SELECT * FROM ev WHERE action = 'delete'",
)
def history_by_action(spark, sf_dir):
    return versions.query_log(B.events_log(spark, sf_dir), action="delete")


@query(
    "history_of_entity",
    f"WITH {EVENTS_LOG} SELECT * FROM ev WHERE n_id = 8 AND status = 'stage'",
)
def history_of_entity(spark, sf_dir):
    return versions.query_log(B.events_log(spark, sf_dir), status="stage", n_id=8)


@query(
    "newest_ids",
    """SELECT user_id AS n_id, max(event_id) AS max_log_id, max(ts) AS max_created_ts
    FROM events GROUP BY user_id""",
)
def newest_ids(spark, sf_dir):
    return versions.newest_ids(B.events_log(spark, sf_dir))


@query(
    "last_names",
    """SELECT user_id AS n_id, props AS name FROM events
    JOIN (SELECT max(event_id) AS m FROM events GROUP BY user_id) ON m = event_id""",
)
def last_names(spark, sf_dir):
    return versions.last_names(B.events_log(spark, sf_dir))


_AMPLIFY = """
    SELECT s.high + 1 + i * s.n + place AS log_id,
           ev.n_id, 'modify' AS action,
           created_ts + (i + 1) * INTERVAL 1 DAY AS created_ts, created_by,
           {status} AS status, {name} || '-' || i AS name, value
    FROM ev {join}
    JOIN (SELECT log_id AS placed, row_number() OVER (ORDER BY log_id) - 1 AS place
          FROM ev) ON placed = ev.log_id
    CROSS JOIN (SELECT unnest(range({copies})) AS i)
    CROSS JOIN (SELECT count(*) AS n, max(log_id) AS high FROM ev) s"""


@query(
    "amplify",
    f"WITH {EVENTS_LOG}"
    + _AMPLIFY.format(
        status="CASE WHEN i % 13 = 0 THEN 'production' "
        "WHEN i % 5 = 0 THEN 'stage' ELSE status END",
        name="l.last",
        join="""JOIN (SELECT n_id, name AS last FROM ev
          JOIN (SELECT max(log_id) AS m FROM ev GROUP BY n_id) ON m = log_id) l
          ON l.n_id = ev.n_id""",
        copies=7,
    ),
)
def amplify(spark, sf_dir):
    return versions.amplify(B.events_log(spark, sf_dir), 7)


@query(
    "amplify_own_names",
    f"WITH {EVENTS_LOG}"
    + _AMPLIFY.format(status="status", name="ev.name", join="", copies=3),
)
def amplify_own_names(spark, sf_dir):
    log = B.events_log(spark, sf_dir)
    return versions.amplify(log, 3, own_name=True, keep_status=True)


# --- scalar functions -------------------------------------------------------


@query(
    "scalar_functions",
    f"""WITH {EVENTS_LOG}
    SELECT log_id,
      CASE status WHEN 'draft' THEN 1 WHEN 'stage' THEN 2 WHEN 'production' THEN 3 END
        AS status_code,
      status AS status_name,
      CASE action WHEN 'create' THEN 1 WHEN 'modify' THEN 2 WHEN 'delete' THEN 3 END
        AS action_code,
      action AS action_name,
      CASE created_by WHEN 'create' THEN 1 WHEN 'modify' THEN 2 WHEN 'delete' THEN 3 END
        AS unknown_code,
      name || '-' || n_id AS numbered_name,
      created_ts + (n_id + 1) * INTERVAL 1 DAY AS shifted_ts,
      CASE WHEN n_id % 13 = 0 THEN 'production' WHEN n_id % 5 = 0 THEN 'stage'
        ELSE status END AS stepped_status,
      created_ts - INTERVAL 5 HOUR AS wall_clock,
      created_by AS bare_name,
      action || '_' || created_by || '_' || status AS vendor_table,
      action || '_' || created_by AS action_table
    FROM ev""",
)
def scalar_functions(spark, sf_dir):
    log = B.events_log(spark, sf_dir)
    status = C.status_code(F.col("status"))
    action = C.action_code(F.col("action"))
    none = F.lit(None).cast("string")
    # The same clock five hours east: an instant that UTC's clock shows earlier.
    text = F.date_format("created_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zoned = F.concat(text, F.lit("+05:00")).cast("timestamp")
    return log.select(
        "log_id",
        status.alias("status_code"),
        C.status_name(status).alias("status_name"),
        action.alias("action_code"),
        C.action_name(action).alias("action_name"),
        C.action_code(F.col("created_by")).alias("unknown_code"),
        C.numbered_name(F.col("name"), F.col("n_id")).alias("numbered_name"),
        C.shifted_day(F.col("created_ts"), F.col("n_id")).alias("shifted_ts"),
        C.stepped_status(F.col("status"), F.col("n_id")).alias("stepped_status"),
        C.wall_clock(zoned).alias("wall_clock"),
        C.bare_table_name(F.concat(F.lit(LEGACY_PREFIX), "created_by")).alias("bare_name"),
        C.table_name(F.col("created_by"), F.col("action"), F.col("status")).alias(
            "vendor_table"
        ),
        C.table_name(F.col("created_by"), F.col("action"), none).alias("action_table"),
    )


@query(
    "column_classes",
    """WITH cat AS (
      SELECT DISTINCT n_name AS t, unnest([n_name || '_id', n_name || '_name', n_name,
        'created_ts', 'updated_by', n_name || '_code', c_mktsegment]) AS c
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT t AS table_name, c AS column_name,
      c IN (t, t || '_name') AS is_name, c = t || '_id' AS is_id,
      c IN ('created_by', 'updated_by', 'created_ts', 'updated_ts') AS is_log,
      c IN (t, t || '_name', t || '_id', 'created_by', 'updated_by', 'created_ts',
        'updated_ts') AS is_standard
    FROM cat""",
)
def column_classes(spark, sf_dir):
    table, column = F.col("table_name"), F.col("column_name")
    named = B.market_catalog(spark, sf_dir).withColumn(
        "table_name", C.bare_table_name(table)
    )
    return named.select(
        "table_name",
        "column_name",
        C.is_name_column(table, column).alias("is_name"),
        C.is_id_column(table, column).alias("is_id"),
        C.is_log_column(column).alias("is_log"),
        C.is_standard_column(table, column).alias("is_standard"),
    )


# --- keys -------------------------------------------------------------------


@query(
    "duplicate_values",
    """SELECT 'o_custkey' AS column_name, count(*) AS duplicates FROM
      (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(o_custkey) > 1)
    UNION ALL SELECT 'o_totalprice', count(*) FROM
      (SELECT o_totalprice FROM orders GROUP BY 1 HAVING count(o_totalprice) > 1)
    UNION ALL SELECT 'o_orderkey', count(*) FROM
      (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(o_orderkey) > 1)""",
)
def duplicate_values(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders")
    return keys.duplicate_values(orders, ["o_custkey", "o_totalprice", "o_orderkey"])


@query(
    "one_to_one",
    """SELECT
      (SELECT count(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1
                             HAVING count(*) > 1)) AS dup_ids,
      (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1
                             HAVING count(*) > 1)) AS dup_ext_ids""",
)
def one_to_one(spark, sf_dir):
    maps = B.legacy_table(spark, sf_dir, "map_part_supplier")
    return keys.one_to_one(maps, "part_id", "ext_id")


@query(
    "members",
    """SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels)""",
)
def members(spark, sf_dir):
    documents = B.read(spark, sf_dir, "documents").drop("text")
    return keys.members(documents, "doc_id", B.read(spark, sf_dir, "labels"), "doc_id")


@query(
    "non_members",
    """SELECT o_orderkey AS log_id, o_orderkey AS n_id, o_custkey AS customer_id,
      o_totalprice AS total FROM orders
    WHERE o_custkey NOT IN (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS key FROM customer)""",
)
def non_members(spark, sf_dir):
    known = B.sound_customers(spark, sf_dir)
    return keys.non_members(B.order_log(spark, sf_dir), "customer_id", known, "c_custkey")


_BRIDGE = """
  b AS (SELECT key AS old_id, key + 1000000000 AS n_id FROM
        (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS key FROM customer))"""


@query(
    "remap_foreign_key",
    f"""WITH {_BRIDGE}
    SELECT o_orderkey AS log_id, o_orderkey AS n_id, b.n_id AS customer_id,
      o_totalprice AS total, b.n_id IS NULL AS bad_customer_id
    FROM orders LEFT JOIN b ON old_id = o_custkey""",
)
def remap_foreign_key(spark, sf_dir):
    bridge = B.customer_bridge(spark, sf_dir)
    return keys.remap_foreign_key(
        B.order_log(spark, sf_dir), "customer_id", "customer", bridge
    )


@query(
    "remap_foreign_key_sentinel",
    f"""WITH {_BRIDGE},
    first AS (SELECT *, CASE WHEN o_custkey NOT IN (SELECT old_id FROM b) THEN 666
              ELSE o_custkey END AS fk FROM orders)
    SELECT o_orderkey AS log_id, o_orderkey AS n_id, coalesce(b.n_id, fk) AS customer_id,
      o_totalprice AS total
    FROM first LEFT JOIN b ON old_id = fk""",
)
def remap_foreign_key_sentinel(spark, sf_dir):
    bridge = B.customer_bridge(spark, sf_dir)
    return keys.remap_foreign_keys(
        B.order_log(spark, sf_dir),
        {"customer_id": "customer"},
        bridge,
        ["customer"],
        use_sentinel=True,
    )


@query(
    "remap_foreign_keys",
    """WITH p AS (SELECT p_partkey AS old_id, 1000 + row_number() OVER (ORDER BY p_partkey) - 1
              AS n_id FROM part),
    s AS (SELECT s_suppkey AS old_id, 1000 + (SELECT count(*) FROM part)
            + row_number() OVER (ORDER BY s_suppkey) - 1 AS n_id
          FROM supplier)
    SELECT l_orderkey AS orders_id, l_linenumber AS line, p.n_id AS part_id,
      s.n_id AS supplier_id, l_quantity AS quantity,
      p.n_id IS NULL AS bad_part_id, s.n_id IS NULL AS bad_supplier_id
    FROM lineitem LEFT JOIN p ON p.old_id = l_partkey
    LEFT JOIN s ON s.old_id = l_suppkey""",
)
def remap_foreign_keys(spark, sf_dir):
    supplier = B.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.lit(None).cast("timestamp_ntz").alias("updated_ts"),
        F.lit(B.WRITTEN_BY).alias("updated_by"),
    )
    legacy = {"part": B.legacy_table(spark, sf_dir, "part"), "supplier": supplier}
    bridge = migrate.number_things(legacy, ["part", "supplier"])
    rows = B.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orders_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
    )
    return keys.remap_foreign_keys(
        rows,
        {"part_id": "part", "supplier_id": "supplier"},
        bridge,
        ["part", "supplier"],
        row_key=["orders_id", "line"],
    )


@query(
    "integrity_report",
    """SELECT 'not_null' AS rule, 'o_orderdate' AS column_name,
      count(*) FILTER (o_orderdate IS NULL) AS violations FROM orders
    UNION ALL SELECT 'max_length', 'o_orderpriority',
      count(*) FILTER (length(o_orderpriority) > 8) FROM orders
    UNION ALL SELECT 'domain', 'o_orderstatus',
      count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'primary_key', 'o_orderkey', count(*) FROM
      (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'foreign_key', 'o_custkey', count(*) FROM orders
      WHERE o_custkey NOT IN
        (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS key FROM customer)""",
)
def integrity_report(spark, sf_dir):
    return keys.integrity_report(
        B.read(spark, sf_dir, "orders"),
        ["o_orderkey"],
        ["o_orderdate"],
        {"o_orderpriority": 8},
        {"o_orderstatus": ["F", "O"]},
        {"o_custkey": B.sound_customers(spark, sf_dir).select("c_custkey")},
    )


@query(
    "primary_key_check",
    """SELECT 'primary_key' AS rule, 'l_orderkey, l_linenumber' AS column_name,
      count(*) AS violations FROM
      (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def primary_key_check(spark, sf_dir):
    lines = B.read(spark, sf_dir, "lineitem")
    return keys.integrity_report(lines, ["l_orderkey", "l_linenumber"])


# --- migration --------------------------------------------------------------


@query(
    "dense_ids",
    """SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) - 1 AS n_id
    FROM orders""",
)
def numbered_orders(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders").select("o_orderkey")
    return dense_ids(orders, "o_orderkey", "n_id", 1000)


@query(
    "short_load",
    """SELECT * EXCLUDE r FROM
      (SELECT *, rank() OVER (ORDER BY c_custkey) AS r FROM customer) WHERE r < 11""",
)
def short_load(spark, sf_dir):
    return migrate.first_by_rank(B.read(spark, sf_dir, "customer"), "c_custkey")


@query(
    "migrate_log",
    """SELECT row_number() OVER (ORDER BY o_orderkey) AS log_id,
      1000 + row_number() OVER (ORDER BY o_orderkey) - 1 AS n_id, 'create' AS action,
      o_orderdate AS created_ts, o_orderpriority AS created_by, 'draft' AS status,
      o_orderstatus AS name, o_custkey AS customer_id, o_totalprice AS total
    FROM orders""",
)
def migrate_log(spark, sf_dir):
    orders = B.legacy_table(spark, sf_dir, "orders")
    return migrate.migrate_thing(orders, "orders", 1000, ["customer_id", "total"]).log


@query(
    "migrate_bridge",
    """SELECT o_orderkey AS old_id, 'orders' AS thing,
      1000 + row_number() OVER (ORDER BY o_orderkey) - 1 AS n_id FROM orders""",
)
def migrate_bridge(spark, sf_dir):
    orders = B.legacy_table(spark, sf_dir, "orders")
    return migrate.migrate_thing(orders, "orders").bridge


@query(
    "migrate_registry",
    """SELECT 1000 + row_number() OVER (ORDER BY c_custkey) - 1 AS n_id,
      'customer' AS thing FROM customer""",
)
def migrate_registry(spark, sf_dir):
    customer = B.legacy_table(spark, sf_dir, "customer")
    return migrate.migrate_thing(customer, "customer").registry


@query(
    "migrate_short",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS log_id,
      5000 + row_number() OVER (ORDER BY c_custkey) - 1 AS n_id, 'create' AS action,
      TIMESTAMP '1998-08-02 00:00:00' AS created_ts, c_mktsegment AS created_by,
      'draft' AS status, c_name AS name FROM customer
    WHERE c_custkey IN (SELECT c_custkey FROM customer ORDER BY 1 LIMIT 10)""",
)
def migrate_short(spark, sf_dir):
    customer = B.legacy_table(spark, sf_dir, "customer")
    return migrate.migrate_thing(customer, "customer", 5000, short_load=True).log


_LOW_PARTS = """SELECT CASE WHEN p_size > 40 THEN -p_partkey ELSE p_partkey END AS p_partkey,
      p_name, p_type FROM part"""


@query(
    "join_thing_and_map",
    f"""SELECT p_partkey AS old_id, p_name AS name,
      TIMESTAMP '1998-08-02 00:00:00' AS t_updated_ts, p_type AS t_updated_by,
      CAST(l_suppkey AS VARCHAR) AS ext_id, l_shipdate AS m_updated_ts,
      l_returnflag AS m_updated_by
    FROM lineitem JOIN ({_LOW_PARTS}) ON p_partkey = l_partkey""",
)
def join_thing_and_map(spark, sf_dir):
    things, maps = _small_parts(spark, sf_dir)
    return migrate.join_thing_and_map(things, maps)


def _small_parts(spark, sf_dir):
    maps = B.legacy_table(spark, sf_dir, "map_part_supplier")
    return (
        migrate.legacy_rows(B.small_parts(spark, sf_dir), "part"),
        migrate.map_rows(maps, "part", "map_part_supplier"),
    )


@query(
    "unbridged",
    """SELECT c_custkey AS old_id FROM customer WHERE c_acctbal < 0""",
)
def unbridged(spark, sf_dir):
    customer = B.legacy_table(spark, sf_dir, "customer")
    things = migrate.legacy_rows(customer, "customer").select("old_id")
    return migrate.unbridged(things, B.customer_bridge(spark, sf_dir))


@query(
    "name_map",
    f"""SELECT n_id, CAST(7 AS BIGINT) AS v_id, 'create' AS action,
      l_shipdate AS created_ts, l_returnflag AS created_by, 'draft' AS status,
      CAST(l_suppkey AS VARCHAR) AS ext_id, 'person' AS map_type,
      CAST(1 AS FLOAT) AS confidence
    FROM lineitem JOIN (SELECT p_partkey,
        1000 + row_number() OVER (ORDER BY p_partkey) - 1 AS n_id FROM ({_LOW_PARTS}))
      ON p_partkey = l_partkey""",
)
def name_map(spark, sf_dir):
    things, maps = _small_parts(spark, sf_dir)
    bridge = dense_ids(things.select("old_id"), "old_id", "n_id", 1000)
    return migrate.name_map_log(maps, bridge, ["old_id"], F.lit(7))


_ALL_IDS = """
  ids AS (SELECT 0 AS o, 'nation' AS thing, n_nationkey AS old_id FROM nation
    UNION ALL SELECT 1, 'customer', c_custkey FROM customer
    UNION ALL SELECT 2, 'orders', o_orderkey FROM orders
    UNION ALL SELECT 3, 'part', p_partkey FROM part),
  b AS (SELECT old_id, thing, 1000 + row_number() OVER (ORDER BY o, old_id) - 1 AS n_id
        FROM ids)"""


def _migration(spark, sf_dir):
    return migrate.migrate_all(
        B.legacy_tables(spark, sf_dir), B.SPECS, B.LEGACY_THINGS, B.LEGACY_VENDORS
    )


@query("migrate_all_bridge", f"WITH {_ALL_IDS} SELECT * FROM b")
def migrate_all_bridge(spark, sf_dir):
    declared = {spec.name for spec in B.SPECS}
    things = [t for t in B.LEGACY_THINGS if t in declared and t in B.LEGACY_TABLES]
    return migrate.number_things(B.legacy_tables(spark, sf_dir, *things), things)


@query(
    "repeated_ids",
    """SELECT thing, count(*) AS ids FROM
      (SELECT 'customer' AS thing FROM orders GROUP BY o_custkey HAVING count(*) > 1
       UNION ALL SELECT 'part' FROM lineitem GROUP BY l_partkey HAVING count(*) > 1)
    GROUP BY thing""",
)
def repeated_ids(spark, sf_dir):
    used = {
        "customer": ("orders", "customer_id", "total"),
        "part": ("map_part_supplier", "part_id", "ext_id"),
    }
    legacy = {
        thing: B.legacy_table(spark, sf_dir, table).select(
            key, F.col(name).alias(thing), "updated_ts", "updated_by"
        )
        for thing, (table, key, name) in used.items()
    }
    return migrate.repeated_ids(migrate.legacy_ids(legacy, list(legacy)))


_SERVED = """
  served AS (SELECT DISTINCT o_custkey AS old_id FROM orders),
  old AS (SELECT old_id, 'customer' AS thing, 7 + old_id * 3 AS n_id FROM served
    UNION ALL SELECT n_nationkey, 'nation', 3000000 + n_nationkey FROM nation)"""


@query(
    "migrate_increment",
    f"""WITH {_ALL_IDS}, {_SERVED},
    reg AS (SELECT n_id FROM old UNION ALL SELECT 5000000 + s_suppkey FROM supplier),
    lacking AS (SELECT ids.* FROM ids LEFT JOIN old USING (thing, old_id)
                WHERE old.n_id IS NULL)
    SELECT old_id, thing,
      (SELECT max(n_id) FROM reg) + row_number() OVER (ORDER BY o, old_id) AS n_id
    FROM lacking""",
)
def migrate_increment(spark, sf_dir):
    """Bridge rows that are added where nations and served customers have theirs."""
    served = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("old_id"))
    nations = B.read(spark, sf_dir, "nation")
    bridge = (
        served.distinct()
        .select("old_id", F.lit("customer").alias("thing"), (7 + F.col("old_id") * 3).alias("n_id"))
        .union(
            nations.select(
                F.col("n_nationkey").cast("long"),
                F.lit("nation"),
                (3_000_000 + F.col("n_nationkey")).cast("long"),
            )
        )
    )
    loaded = B.read(spark, sf_dir, "supplier").select(
        (5_000_000 + F.col("s_suppkey")).alias("n_id")
    )
    registry = bridge.select("n_id").union(loaded)
    declared = {spec.name for spec in B.SPECS}
    things = [t for t in B.LEGACY_THINGS if t in declared and t in B.LEGACY_TABLES]
    ids = migrate.legacy_ids(B.legacy_tables(spark, sf_dir, *things), things)
    return migrate.number_new_things(ids, bridge, next_id(registry, "n_id", 1000))


@query(
    "aligned_log",
    """SELECT o_orderkey AS log_id, CAST(NULL AS BIGINT) AS n_id, 'create' AS action,
      o_orderdate AS created_ts, CAST(NULL AS VARCHAR) AS created_by,
      CAST(NULL AS VARCHAR) AS status, o_orderpriority AS name, o_custkey AS customer_id,
      o_totalprice AS total FROM orders""",
)
def aligned_log(spark, sf_dir):
    """Rows in the declared layout of their table: order, types, missing columns."""
    spec = next(s for s in B.SPECS if s.name == "orders")
    layout = spark.createDataFrame([], struct_type(entity_columns(spec)))
    orders = B.read(spark, sf_dir, "orders").select(
        F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_ts"),
        F.lit("create").alias("action"),
        F.col("o_orderkey").alias("log_id"),
    )
    return aligned(orders, layout)


@query("migrate_all_registry", f"WITH {_ALL_IDS} SELECT n_id, thing FROM b")
def migrate_all_registry(spark, sf_dir):
    return _migration(spark, sf_dir).registry()


@query(
    "migrate_all_log",
    f"""WITH {_ALL_IDS}
    SELECT row_number() OVER (ORDER BY c_custkey) AS log_id, n_id, 'create' AS action,
      TIMESTAMP '1998-08-02 00:00:00' AS created_ts, c_mktsegment AS created_by,
      'draft' AS status, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance
    FROM customer JOIN b ON old_id = c_custkey AND thing = 'customer'""",
)
def migrate_all_log(spark, sf_dir):
    return _migration(spark, sf_dir).log("customer")


@query(
    "migrate_all_name_map",
    f"""WITH {_ALL_IDS},
    maps AS (
      SELECT 'customer' AS thing, 26 AS v_id, user_id AS old_id, props AS ext_id,
        ts AS created_ts, event_type AS created_by FROM events
      UNION ALL SELECT 'orders', 5, l_orderkey, l_partkey || '-' || l_linenumber,
        l_shipdate, l_returnflag FROM lineitem
      UNION ALL SELECT 'part', 27, l_partkey, CAST(l_suppkey AS VARCHAR), l_shipdate,
        l_returnflag FROM lineitem)
    SELECT n_id, CAST(v_id AS BIGINT) AS v_id, 'create' AS action, created_ts, created_by,
      'draft' AS status, ext_id, 'person' AS map_type, CAST(1 AS FLOAT) AS confidence
    FROM maps JOIN b ON b.old_id = maps.old_id AND b.thing = maps.thing""",
)
def migrate_all_name_map(spark, sf_dir):
    vendors = B.read(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("v_id"),
        F.when(F.col("n_nationkey") == 4, "line")
        .otherwise(F.col("n_name"))
        .alias("vendor"),
        F.lit("main").alias("database"),
    )
    plan = _migration(spark, sf_dir)
    return plan.name_map(plan.vendor_ids(vendors)[0])


@query(
    "vendor_ids",
    """WITH reg AS (SELECT n_nationkey + 1 AS v_id, 'Brand#' || n_nationkey AS vendor,
        CASE n_regionkey WHEN 0 THEN 'archive' ELSE 'main' END AS database FROM nation),
    known AS (SELECT vendor, min(v_id) AS v_id FROM reg WHERE database = 'main'
              GROUP BY vendor),
    wanted AS (SELECT DISTINCT p_brand AS vendor FROM part)
    SELECT w.vendor, CAST(v_id AS BIGINT) AS v_id FROM wanted w JOIN known USING (vendor)
    UNION ALL
    SELECT vendor, (SELECT max(v_id) FROM reg) + row_number() OVER (ORDER BY vendor)
    FROM wanted WHERE vendor NOT IN (SELECT vendor FROM known)""",
)
def vendor_ids(spark, sf_dir):
    registry = B.read(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("v_id"),
        F.concat(F.lit("Brand#"), "n_nationkey").alias("vendor"),
        F.when(F.col("n_regionkey") == 0, "archive").otherwise("main").alias("database"),
    )
    brands = B.read(spark, sf_dir, "part").select(F.col("p_brand").alias("vendor"))
    return migrate.assign_vendor_ids(registry, brands.distinct())[0]


# --- loads ------------------------------------------------------------------


def _registry(spark, sf_dir):
    """Customers as registered things; furniture makers under ids that no row has."""
    customers = B.read(spark, sf_dir, "customer")
    kind = F.when(F.col("c_acctbal") >= 0, "customer").otherwise("prospect")
    other = F.when(F.col("c_mktsegment") == "FURNITURE", -F.col("c_custkey"))
    return customers.select(
        F.coalesce(other, "c_custkey").alias("n_id"), kind.alias("thing")
    )


def _new_suppliers(spark, sf_dir):
    return B.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("row_no"),
        F.col("s_name").alias("name"),
        F.lit("draft").alias("status"),
    )


def _new_parts(spark, sf_dir):
    return B.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_no"),
        F.col("p_name").alias("name"),
        F.lit("stage").alias("status"),
    )


def _changed_users(spark, sf_dir):
    return B.events_log(spark, sf_dir).select(
        F.col("log_id").alias("row_no"), "n_id", "name", "status"
    )


def _changed_buyers(spark, sf_dir):
    """Orders as changes of their customers, or else of the last registered one."""
    known = _registry(spark, sf_dir).where("thing = 'customer'")
    orders = B.read(spark, sf_dir, "orders")
    joined = orders.join(known, F.col("o_custkey") == F.col("n_id"), "left")
    return joined.select(
        F.col("o_orderkey").alias("row_no"),
        F.coalesce("n_id", known.agg(F.max("n_id")).scalar()).alias("n_id"),
        F.col("o_orderpriority").alias("name"),
        F.lit("production").alias("status"),
    )


_REGISTRY_SQL = """
  reg AS (SELECT
            CASE c_mktsegment WHEN 'FURNITURE' THEN -c_custkey ELSE c_custkey END AS n_id,
            CASE WHEN c_acctbal >= 0 THEN 'customer' ELSE 'prospect' END AS thing
          FROM customer),
  buyer AS (SELECT o.*, coalesce(n_id, (SELECT max(n_id) FROM reg WHERE thing = 'customer'))
            AS n_id
          FROM orders o LEFT JOIN reg ON n_id = o_custkey AND thing = 'customer')"""


@query(
    "load_errors",
    f"""WITH {_REGISTRY_SQL}
    SELECT CAST(1 AS BIGINT) AS batch_no, user_id AS n_id, thing AS found,
      CASE WHEN thing IS NULL THEN 'unknown' ELSE 'wrong_thing' END AS problem,
      count(*) AS n_rows
    FROM events LEFT JOIN reg ON reg.n_id = user_id
    WHERE thing IS NULL OR thing <> 'customer' GROUP BY ALL""",
)
def load_errors(spark, sf_dir):
    rows, registry = _changed_users(spark, sf_dir), _registry(spark, sf_dir)
    errors = load.load_rows(rows, registry, "customer", "row_no").errors
    return errors.withColumn("batch_no", F.col("batch_no").cast("long"))


@query(
    "load_create",
    f"""WITH {_REGISTRY_SQL}
    SELECT s_suppkey AS row_no, s_name AS name, 'draft' AS status,
      (SELECT max(n_id) FROM reg) + row_number() OVER (ORDER BY s_suppkey) AS n_id,
      'create' AS action, 500 + row_number() OVER (ORDER BY s_suppkey) - 1 AS log_id
    FROM supplier""",
)
def load_create(spark, sf_dir):
    loaded = load.load_rows(
        _new_suppliers(spark, sf_dir),
        _registry(spark, sf_dir),
        "customer",
        "row_no",
        first_log_id=500,
    )
    return loaded.rows.drop("batch_no")


@query(
    "load_new_things",
    f"""WITH {_REGISTRY_SQL}
    SELECT (SELECT max(n_id) FROM reg) + row_number() OVER (ORDER BY p_partkey) AS n_id,
      'customer' AS thing FROM part""",
)
def load_new_things(spark, sf_dir):
    parts, registry = _new_parts(spark, sf_dir), _registry(spark, sf_dir)
    return load.load_rows(parts, registry, "customer", "row_no").new_things


@query(
    "load_modify",
    f"""WITH {_REGISTRY_SQL}
    SELECT o_orderkey AS row_no, n_id, o_orderpriority AS name,
      'production' AS status, 'modify' AS action
    FROM buyer""",
)
def load_modify(spark, sf_dir):
    rows, registry = _changed_buyers(spark, sf_dir), _registry(spark, sf_dir)
    return load.load_rows(rows, registry, "customer", "row_no").rows.drop("batch_no")


@query(
    "load_series",
    f"""WITH {_REGISTRY_SQL},
    given AS (SELECT 1 AS b, s_suppkey AS row_no, s_name AS name, 'draft' AS status,
        NULL AS n_id FROM supplier
      UNION ALL SELECT 2, event_id, NULL, NULL, user_id FROM events
      UNION ALL SELECT 3, o_orderkey, o_orderpriority, 'production', n_id FROM buyer
      UNION ALL SELECT 4, p_partkey, p_name, 'stage', NULL FROM part),
    placed AS (SELECT *, row_number() OVER (ORDER BY b, row_no) AS log_id,
        sum(CASE WHEN n_id IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY b, row_no) AS made
      FROM given)
    SELECT CAST(b AS BIGINT) AS batch_no, row_no, name, status,
      CASE WHEN n_id IS NULL THEN 'create' ELSE 'modify' END AS action,
      CAST(coalesce(n_id, (SELECT max(n_id) FROM reg) + made) AS BIGINT) AS n_id, log_id
    FROM placed WHERE b <> 2""",
)
def load_series(spark, sf_dir):
    # The second batch refers to ids it must not change, so it is left out.
    batches = [
        _new_suppliers(spark, sf_dir),
        _changed_users(spark, sf_dir),
        _changed_buyers(spark, sf_dir),
        _new_parts(spark, sf_dir),
    ]
    registry = _registry(spark, sf_dir)
    loaded = load.load_series(batches, registry, "customer", "row_no", first_log_id=1)
    return loaded.rows.withColumn("batch_no", F.col("batch_no").cast("long"))


# --- files and jobs ---------------------------------------------------------


@query(
    "load_file",
    """SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate,
      row_number() OVER (ORDER BY o_orderkey) AS place FROM orders""",
)
def load_file(spark, sf_dir):
    """Orders by way of a folder of CSV files whose header has another order."""
    path = B.scratch(spark)
    orders = B.read(spark, sf_dir, "orders").orderBy("o_orderkey")
    named = ["o_orderdate", "o_totalprice", "o_orderkey", "o_orderpriority"]
    files.write_rows(orders.select(*named), path, "csv")
    layout = (
        "o_orderkey bigint, o_orderpriority string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    )
    return _placed(files.read_load_file(spark, path, layout, "csv", "row_no"))


def _placed(rows):
    """Rows of a file with their place in it."""
    return dense_ids(rows, "row_no", "place", 1).drop("row_no")


@query(
    "load_from_file",
    f"""WITH {_REGISTRY_SQL}
    SELECT s_name AS name, 'draft' AS status, 'create' AS action,
      (SELECT max(n_id) FROM reg) + row_number() OVER (ORDER BY s_suppkey DESC) AS n_id,
      row_number() OVER (ORDER BY s_suppkey DESC) AS log_id
    FROM supplier""",
)
def load_from_file(spark, sf_dir):
    """New things from a JSON file, numbered in the order of its lines."""
    path = B.scratch(spark)
    rows = _new_suppliers(spark, sf_dir).orderBy(F.desc("row_no"))
    files.write_rows(rows.select("name", "status"), path, "json")
    batch = files.read_load_file(spark, path, "name string, status string", "json", "place")
    loaded = load.load_rows(
        batch, _registry(spark, sf_dir), "customer", "place", first_log_id=1
    )
    return loaded.rows.drop("batch_no", "place")


@query(
    "load_series_files",
    f"""WITH {_REGISTRY_SQL}
    SELECT dense_rank() OVER (ORDER BY p_size) AS batch_no, p_name AS name, 'stage' AS status,
      'create' AS action,
      (SELECT max(n_id) FROM reg) + row_number() OVER (ORDER BY p_size, p_partkey) AS n_id,
      row_number() OVER (ORDER BY p_size, p_partkey) AS log_id
    FROM part""",
)
def load_series_files(spark, sf_dir):
    """Parts as new things, a folder of JSON files for each size, all read by one scan."""
    path = B.scratch(spark)
    parts = B.read(spark, sf_dir, "part").withColumn("status", F.lit("stage"))
    rows = parts.select("p_size", "p_partkey", F.col("p_name").alias("name"), "status")
    placed = rows.repartition("p_size").sortWithinPartitions("p_size", "p_partkey")
    placed.drop("p_partkey").write.partitionBy("p_size").json(path)
    # At most 50 sizes.
    sizes = sorted(r.p_size for r in rows.select("p_size").distinct().collect())
    given = files.read_load_series(
        spark, [f"{path}/p_size={n}" for n in sizes], "name string, status string", "json", "place"
    )
    series = load.Series(given, [True] * len(sizes))
    loaded = load.load_series(
        series, _registry(spark, sf_dir), "customer", "place", first_log_id=1
    )
    return loaded.rows.withColumn("batch_no", F.col("batch_no").cast("long")).drop("place")


@query(
    "category_file",
    """SELECT p_size AS category_id, p_name AS category_name FROM part
    JOIN (SELECT max(p_partkey) AS m FROM part GROUP BY p_size) ON m = p_partkey""",
)
def category_file(spark, sf_dir):
    """Category names of a CSV file, the last line of an id winning."""
    path = B.scratch(spark)
    categories = _categories(spark, sf_dir).orderBy("row_no")
    files.write_rows(categories.select("category_name", "category_id"), path, "csv")
    layout = "category_id int, category_name string"
    read = files.read_load_file(spark, path, layout, "csv", "row_no")
    return hierarchy.category_names(read, "row_no")


# --- audit ------------------------------------------------------------------


@query(
    "table_sizes",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {n} AS columns, count(*) AS rows FROM {t}"
        for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11), ("events", 6))
    ),
)
def table_sizes(spark, sf_dir):
    sizes = []
    for name in ("customer", "orders", "lineitem", "events"):
        table = B.read(spark, sf_dir, name)
        sizes.append(
            table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(len(table.columns)).alias("columns"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, sizes)


_ACTIVITY_SQL = """
  seen AS (SELECT DISTINCT lower(c_mktsegment) AS t, event_type AS a, lower(n_name) AS v
    FROM events JOIN customer ON c_custkey = user_id
    JOIN nation ON n_nationkey = c_nationkey),
  names AS (SELECT t AS n FROM seen UNION SELECT a || '_' || t FROM seen
    UNION SELECT a || '_' || t || '_' || v FROM seen),
  th AS (SELECT * FROM (VALUES (0, 'building'), (1, 'automobile'), (2, 'machinery'),
    (3, 'household'), (4, 'aircraft')) AS x(i, t)),
  ac AS (SELECT * FROM (VALUES (0, 'purchase'), (1, 'view'), (2, 'error')) AS x(j, a)),
  ve AS (SELECT i AS k, 'nation_' || i AS v FROM range(25) AS r(i)),
  cand AS (SELECT i * 104 AS position, t AS table_name, t AS thing,
        NULL AS action, NULL AS vendor FROM th
    UNION ALL SELECT i * 104 + j + 1, a || '_' || t, t, a, NULL FROM th, ac
    UNION ALL SELECT i * 104 + (k + 1) * 4 + j + 1, a || '_' || t || '_' || v, t, a, v
      FROM th, ac, ve)"""


@query(
    "enumerate_tables",
    f"""WITH {_ACTIVITY_SQL}
    SELECT position, table_name, thing, action, vendor FROM cand
    WHERE table_name IN (SELECT n FROM names) AND thing IN (SELECT n FROM names)""",
)
def enumerate_tables(spark, sf_dir):
    things, vendors = B.ACTIVITY_THINGS, B.ACTIVITY_VENDORS
    found = audit.enumerate_tables(
        B.activity_names(spark, sf_dir), things, vendors, B.ACTIVITY_ACTIONS
    )
    return found.select(
        audit.report_position(found, len(vendors), len(B.ACTIVITY_ACTIONS)).alias(
            "position"
        ),
        "table_name",
        "thing",
        "action",
        "vendor",
    )


_RULE_ACTION = """CASE event_type WHEN 'purchase' THEN 'map' WHEN 'view' THEN 'fuzzymatch'
      WHEN 'error' THEN 'import' ELSE 'exp' END"""


@query(
    "column_rules",
    f"""WITH seen AS (
      SELECT lower(c_mktsegment) AS t, {_RULE_ACTION} AS a, lower(n_name) AS v,
        count(*) AS n
      FROM events JOIN customer ON c_custkey = user_id
      JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
    tab AS (
      SELECT t, NULL AS a, NULL AS v, t AS table_name, n FROM seen
      UNION ALL SELECT t, a, NULL, a || '_' || t, n FROM seen
      UNION ALL SELECT t, a, v, a || '_' || t || '_' || v, n FROM seen),
    sized AS (SELECT t, a, v, table_name, sum(n) AS n FROM tab GROUP BY ALL),
    th AS (SELECT * FROM (VALUES (0, 'building'), (1, 'automobile'), (2, 'machinery'),
      (3, 'household'), (4, 'aircraft')) AS x(i, t)),
    ac AS (SELECT * FROM (VALUES (0, 'map'), (1, 'fuzzymatch'), (2, 'import'), (3, 'exp'),
      (4, 'history')) AS x(j, a)),
    ve AS (SELECT i AS k, 'nation_' || i AS v FROM range(25) AS r(i))
    SELECT i * 156 + coalesce(k + 1, 0) * 6 + coalesce(j + 1, 0) AS position, table_name,
      CASE WHEN a IS NULL OR (v IS NOT NULL AND a IN ('map', 'fuzzymatch'))
        THEN n % 3 > 0 END AS good_id,
      CASE WHEN a IS NULL OR v IS NULL OR a = 'import' THEN n % 2 > 0 END AS good_name,
      CASE WHEN a IS NULL OR (v IS NOT NULL AND a IN ('map', 'fuzzymatch'))
        THEN n % 5 > 0 AND n % 7 > 0 AND n % 11 > 0 END AS good_log,
      CASE WHEN a IN ('map', 'fuzzymatch') THEN n % 4 > 0 END AS good_ext,
      CAST(7 AS BIGINT) AS columns
    FROM sized JOIN th USING (t) LEFT JOIN ac USING (a) LEFT JOIN ve USING (v)
    WHERE v IS NULL OR k IS NOT NULL""",
)
def column_rules(spark, sf_dir):
    return audit.column_rules(
        B.typed_catalog(spark, sf_dir), B.ACTIVITY_THINGS, B.ACTIVITY_VENDORS, B.LEGACY_ACTIONS
    )


def _dups(table: str, column: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY 1 "
        f"HAVING count({column}) > 1))"
    )


def _report_row(
    name, thing, action, vendor, good_id, good_name, good_log, columns, table, i, e
):
    def text(value):
        return "NULL" if value is None else f"'{value}'"

    def flag(value):
        return "CAST(NULL AS BOOLEAN)" if value is None else str(value).lower()

    return f"""SELECT {text(name)} AS table_name, {text(thing)} AS thing,
      {text(action)} AS action, {text(vendor)} AS vendor, {flag(good_id)} AS good_id,
      {flag(good_name)} AS good_name, {flag(good_log)} AS good_log,
      CAST({columns} AS BIGINT) AS columns,
      (SELECT count(*) FROM {table}) AS rows, {i} AS dup_id, {e} AS dup_ext_id"""


@query(
    "validation_report",
    " UNION ALL ".join(
        [
            _report_row("nation", "nation", None, None, True, True, True, 7, "nation", 0, 0),
            _report_row(
                "customer", "customer", None, None, True, True, True, 8, "customer", 0, 0
            ),
            _report_row(
                "map_customer_segment", "customer", "map", "segment", True, None, False, 2,
                "customer", "NULL", "NULL",
            ),
            _report_row(
                "map_customer_activity", "customer", "map", "activity", True, None, True,
                6, "events", _dups("events", "user_id"), _dups("events", "props"),
            ),
            _report_row(
                "orders", "orders", None, None, True, True, True, 8, "orders", 0, 0
            ),
            _report_row(
                "map_orders_line", "orders", "map", "line", True, None, True, 6, "lineitem",
                _dups("lineitem", "l_orderkey"),
                _dups("lineitem", "(l_partkey || '-' || l_linenumber)"),
            ),
            _report_row("part", "part", None, None, True, True, True, 7, "part", 0, 0),
            _report_row(
                "import_part", "part", "import", None, None, True, None, 2, "part", 0, 0
            ),
            _report_row(
                "map_part_supplier", "part", "map", "supplier", True, None, True, 6,
                "lineitem", _dups("lineitem", "l_partkey"), _dups("lineitem", "l_suppkey"),
            ),
            _report_row(
                "import_part_supplier", "part", "import", "supplier", None, False, None, 2,
                "supplier", 0, 0,
            ),
        ]
    ),
)
def validation_report(spark, sf_dir):
    tables = B.legacy_tables(spark, sf_dir)
    report = audit.validation_report(
        tables,
        catalog_of(spark, tables),
        B.LEGACY_THINGS,
        B.LEGACY_VENDORS,
        B.LEGACY_ACTIONS,
    )
    return report.drop("position").withColumnsRenamed(
        {"dup id": "dup_id", "dup ext_id": "dup_ext_id"}
    )


@query(
    "report_file",
    f"""SELECT *, row_number() OVER (ORDER BY list_position(['nation', 'customer',
        'map_customer_segment', 'map_customer_activity', 'orders', 'map_orders_line',
        'part', 'import_part', 'map_part_supplier', 'import_part_supplier'],
        table_name)) AS place FROM ({SQL["validation_report"]})""",
)
def report_file(spark, sf_dir):
    """The report of the check job by way of its file, in the order of the file."""
    path, tables = B.scratch(spark), B.legacy_tables(spark, sf_dir)
    report = jobs.check(
        tables, spark, B.LEGACY_THINGS, B.LEGACY_VENDORS, B.LEGACY_ACTIONS
    )
    files.write_rows(report, path, "csv")
    read = files.read_load_file(spark, path, report.schema, "csv", "row_no")
    return _placed(read).withColumnsRenamed(
        {"dup id": "dup_id", "dup ext_id": "dup_ext_id"}
    )


@query(
    "job_fill",
    f"""WITH {_ALL_IDS}
    SELECT row_number() OVER (ORDER BY c_custkey) AS log_id, n_id, 'create' AS action,
      TIMESTAMP '1998-08-02 00:00:00' AS created_ts, c_mktsegment AS created_by,
      'draft' AS status, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation_id,
      c_acctbal AS balance, CAST(NULL AS VARCHAR) AS nick_name
    FROM customer JOIN b ON old_id = c_custkey AND thing = 'customer'""",
)
def job_fill(spark, sf_dir):
    """The customers' table after a whole migration that ran twice."""
    return spark.table(f"{_filled(spark, sf_dir, 2)}.customer")


def _filled(spark, sf_dir, times=1):
    """A new database with the migrated legacy tables."""
    database = B.new_database(spark)
    create_tables(spark, database, B.SPECS)
    legacy = B.legacy_tables(spark, sf_dir)
    for _ in range(times):
        jobs.fill(legacy, spark, database, B.SPECS, B.LEGACY_THINGS, B.LEGACY_VENDORS)
    return database


@query(
    "job_name_map",
    f"""WITH {_ALL_IDS},
    maps AS (
      SELECT 'customer' AS thing, 2 AS v_id, user_id AS old_id, props AS ext_id,
        ts AS created_ts, event_type AS created_by FROM events
      UNION ALL SELECT 'orders', 1, l_orderkey, l_partkey || '-' || l_linenumber,
        l_shipdate, l_returnflag FROM lineitem
      UNION ALL SELECT 'part', 3, l_partkey, CAST(l_suppkey AS VARCHAR), l_shipdate,
        l_returnflag FROM lineitem)
    SELECT n_id, v_id, ext_id, created_ts, created_by, count(*) AS rows
    FROM maps JOIN b ON b.old_id = maps.old_id AND b.thing = maps.thing GROUP BY ALL""",
)
def job_name_map(spark, sf_dir):
    """The name map after a whole migration, its rows counted."""
    database = _filled(spark, sf_dir)
    vendors = spark.table(f"{database}.vendor").select("v_id", "vendor")
    fixed = F.when(F.col("vendor") == "line", 1).when(F.col("vendor") == "activity", 2)
    named = vendors.select("v_id", fixed.otherwise(3).alias("fixed"))
    keys = ["n_id", "fixed", "ext_id", "created_ts", "created_by"]
    return (
        spark.table(f"{database}.name_map")
        .join(F.broadcast(named), "v_id")
        .select(*keys, F.col("log_id").isNotNull().alias("numbered"))
        # Nearly all rows are different: counting them before the shuffle too would only spill.
        .repartition(*keys)
        .groupBy(*keys)
        .agg(F.count_if("numbered").alias("rows"))
        .withColumnRenamed("fixed", "v_id")
    )


def _in_steps(spark, sf_dir):
    """Legacy tables of a first and of a second fill; customers of furniture makers refer
    to nations that there are none of."""
    legacy = B.legacy_tables(spark, sf_dir)
    odd = F.when(F.col("created_by") == "FURNITURE", -F.col("nation_id") - 1)
    customers = legacy["customer"]
    customers = customers.withColumn("nation_id", F.coalesce(odd, "nation_id"))
    whole = {**legacy, "customer": customers}
    first = {
        **whole,
        "customer": customers.where("balance >= 0"),
        "map_customer_activity": legacy["map_customer_activity"].where("created_by <> 'view'"),
        "map_part_supplier": legacy["map_part_supplier"].where("created_by = 'N'"),
    }
    return first, whole


@query(
    "job_fill_after_link",
    """WITH first AS (
      SELECT 0 AS o, n_nationkey AS old_id FROM nation
      UNION ALL SELECT 1, c_custkey FROM customer WHERE c_acctbal >= 0
      UNION ALL SELECT 2, o_orderkey FROM orders UNION ALL SELECT 3, p_partkey FROM part),
    numbered AS (SELECT o, old_id, 999 + row_number() OVER (ORDER BY o, old_id) AS n_id
      FROM first),
    b AS (SELECT * FROM numbered UNION ALL
      SELECT 1, c_custkey, (SELECT max(n_id) FROM numbered)
        + row_number() OVER (ORDER BY c_custkey) FROM customer WHERE c_acctbal < 0)
    SELECT row_number() OVER (ORDER BY c.n_id) AS log_id, c.n_id, c_name AS name,
      n.n_id AS nation_id, n.n_id IS NULL AS bad_nation_id
    FROM customer JOIN b c ON c.o = 1 AND c.old_id = c_custkey
    LEFT JOIN b n ON n.o = 0 AND n.old_id = c_nationkey AND c_mktsegment <> 'FURNITURE'""",
)
def job_fill_after_link(spark, sf_dir):
    """Customers after a fill, new foreign keys, a fill of those in debt, and a second remap."""
    database = B.new_database(spark)
    create_tables(spark, database, B.SPECS)
    spec = next(s for s in B.SPECS if s.name == "customer")
    for legacy in _in_steps(spark, sf_dir):
        jobs.fill(legacy, spark, database, B.SPECS, B.LEGACY_THINGS, B.LEGACY_VENDORS)
        jobs.store_foreign_keys(spark, database, spec, B.SPECS)
    log = spark.table(f"{database}.customer")
    return log.select("log_id", "n_id", "name", "nation_id", "bad_nation_id")


_NAMED = """
    maps AS (
      SELECT 'customer' AS thing, 2 AS v_id, user_id AS old_id, props AS ext_id,
        ts AS created_ts, event_type AS created_by FROM events
      UNION ALL SELECT 'orders', 1, l_orderkey, l_partkey || '-' || l_linenumber,
        l_shipdate, l_returnflag FROM lineitem
      UNION ALL SELECT 'part', 3, l_partkey, CAST(l_suppkey AS VARCHAR), l_shipdate,
        l_returnflag FROM lineitem),
    named AS (SELECT CASE thing WHEN 'customer' THEN c_name WHEN 'part' THEN p_name
          ELSE o_orderstatus END AS name, m.* FROM maps m
        LEFT JOIN customer ON thing = 'customer' AND c_custkey = old_id
        LEFT JOIN orders ON thing = 'orders' AND o_orderkey = old_id
        LEFT JOIN part ON thing = 'part' AND p_partkey = old_id)"""


def _filled_in_steps(spark, sf_dir):
    database = B.new_database(spark)
    create_tables(spark, database, B.SPECS)
    for legacy in _in_steps(spark, sf_dir):
        jobs.fill(legacy, spark, database, B.SPECS, B.LEGACY_THINGS, B.LEGACY_VENDORS)
    return database


@query(
    "job_fill_in_steps",
    f"""WITH {_NAMED}
    SELECT thing, v_id, old_id, ext_id, created_ts, created_by, count(*) AS rows
    FROM named WHERE name IS NOT NULL GROUP BY ALL""",
)
def job_fill_in_steps(spark, sf_dir):
    """The name map under old ids, its rows counted, after two fills."""
    database = _filled_in_steps(spark, sf_dir)
    vendors = spark.table(f"{database}.vendor").select("v_id", "vendor")
    fixed = F.when(F.col("vendor") == "line", 1).when(F.col("vendor") == "activity", 2)
    named = vendors.select("v_id", fixed.otherwise(3).alias("fixed"))
    return (
        spark.table(f"{database}.name_map")
        # Only whether there is a log id travels to the bridge.
        .withColumn("numbered", F.col("log_id").isNotNull())
        .join(F.broadcast(named), "v_id")
        .join(spark.table(f"{database}.old_new_bridge"), "n_id")
        # An entity has one new id: grouped by it too, the rows stay where the join has them.
        .groupBy(
            "n_id",
            "thing",
            F.col("fixed").alias("v_id"),
            "old_id",
            "ext_id",
            "created_ts",
            "created_by",
        )
        .agg(F.count_if("numbered").alias("rows"))
        .drop("n_id")
    )


@query(
    "job_name_map_ids",
    f"""WITH {_NAMED}
    SELECT row_number() OVER (ORDER BY old_id) AS log_id FROM named WHERE name IS NOT NULL""",
)
def job_name_map_ids(spark, sf_dir):
    """The log ids of the name map after two fills: without gaps, none twice."""
    return spark.table(f"{_filled_in_steps(spark, sf_dir)}.name_map").select("log_id")


@query(
    "job_gate",
    """SELECT 'foreign_key' AS rule, 'nation_id' AS column_name, count(*) AS violations,
      (SELECT count(*) FROM customer) AS published
    FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'max_length', 'nick_name', count(*), (SELECT count(*) FROM customer)
    FROM orders WHERE length(o_orderpriority) > 8
      AND o_custkey IN (SELECT c_custkey FROM customer)""",
)
def job_gate(spark, sf_dir):
    """What stops a load of orders as changes of customers, and the rows there after it.

    Finished orders refer to a nation that there is none of, and urgent or unspecified
    ones give a nick name that is too long.
    """
    database = _filled(spark, sf_dir)
    spec = next(s for s in B.SPECS if s.name == "customer")
    jobs.store_foreign_keys(spark, database, spec, B.SPECS)
    customers = spark.table(f"{database}.old_new_bridge").where("thing = 'customer'")
    changes = B.read(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("old_id")
    )
    long = F.char_length("o_orderpriority") > 8
    batch = changes.select(
        F.col("o_orderkey").alias("row_no"),
        "n_id",
        F.col("o_orderpriority").alias("name"),
        F.when(long, F.repeat("o_orderpriority", F.lit(9))).alias("nick_name"),
        F.when(F.col("o_orderstatus") == "F", 999_999_999).alias("nation_id"),
    )
    try:
        jobs.load(spark, database, "customer", [batch], "row_no")
        broken = []
    except jobs.IntegrityError as stopped:
        broken = [(rule, column, n) for _, rule, column, n in stopped.violations]
    found = spark.createDataFrame(broken, "rule string, column_name string, violations long")
    rows = spark.table(f"{database}.customer").agg(F.count("log_id")).scalar()
    return found.withColumn("published", rows)


@query(
    "job_link_load_query",
    f"""WITH {_ALL_IDS},
    nations AS (SELECT old_id, n_id FROM b WHERE thing = 'nation'),
    last AS (SELECT b.n_id, max(o_orderkey) AS o_orderkey FROM orders
      JOIN b ON b.old_id = o_custkey AND thing = 'customer' GROUP BY ALL)
    SELECT b.n_id, CASE WHEN o.o_orderkey IS NULL THEN 'create' ELSE 'modify' END AS action,
      CASE WHEN o.o_orderkey IS NULL THEN 'draft' ELSE 'stage' END AS status,
      coalesce(o_orderpriority, c_name) AS name,
      CASE WHEN o.o_orderkey IS NULL THEN nations.n_id END AS nation_id,
      CASE WHEN o.o_orderkey IS NULL THEN false END AS bad_nation_id
    FROM customer JOIN b ON b.old_id = c_custkey AND thing = 'customer'
    JOIN nations ON nations.old_id = c_nationkey
    LEFT JOIN last ON last.n_id = b.n_id LEFT JOIN orders o USING (o_orderkey)""",
)
def job_link_load_query(spark, sf_dir):
    """Newest customers after migration, new foreign keys and a load of their orders."""
    database = _filled(spark, sf_dir)
    spec = next(s for s in B.SPECS if s.name == "customer")
    jobs.store_foreign_keys(spark, database, spec, B.SPECS)
    customers = spark.table(f"{database}.old_new_bridge").where("thing = 'customer'")
    changes = B.read(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("old_id")
    )
    batch = changes.select(
        F.col("o_orderkey").alias("row_no"),
        "n_id",
        F.col("o_orderpriority").alias("name"),
        F.lit("stage").alias("status"),
    )
    for _ in range(2):
        jobs.load(spark, database, "customer", [batch], "row_no", "orders")
    newest = jobs.query(spark, database, "customer", latest=True)
    return newest.select("n_id", "action", "status", "name", "nation_id", "bad_nation_id")


def _kept(spark, sf_dir):
    """Events appended in three parts, newest versions kept up to the second of them."""
    database = B.new_database(spark)
    log = B.events_log(spark, sf_dir)
    high = log.agg(F.max("log_id")).scalar()
    parted = log.withColumn("_part", F.floor(F.col("log_id") * 3 / (high + 1)))
    log.where("false").write.saveAsTable(f"{database}.users", format="parquet")
    jobs.keep_newest(spark, database, "users")
    for k in range(3):
        part = parted.where(F.col("_part") == k).drop("_part")
        append_rows(part, f"{database}.users")
        if k < 2:
            jobs.add_newest(spark, database, "users")
    return database


@query("job_newest_kept", SQL["latest_versions"])
def job_newest_kept(spark, sf_dir):
    """Newest versions from those kept beside a table and the rows appended since."""
    return jobs.query(spark, _kept(spark, sf_dir), "users", latest=True)


@query("job_newest_kept_filtered", SQL["latest_filtered"])
def job_newest_kept_filtered(spark, sf_dir):
    """Newest of the versions in production that modify, from those kept."""
    database = _kept(spark, sf_dir)
    return jobs.query(spark, database, "users", "production", "modify", latest=True)


@query(
    "schema_difference",
    """WITH cat AS (
      SELECT DISTINCT n_name AS t, unnest([n_name || '_code', c_mktsegment]) AS c
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    dec AS (SELECT DISTINCT n_name AS t, c_mktsegment AS c FROM customer
      JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 8000)
    SELECT t AS table_name, c AS column_name, 'string' AS data_type FROM cat
    WHERE (t, c) NOT IN (SELECT (t, c) FROM dec)""",
)
def schema_difference(spark, sf_dir):
    return audit.schema_difference(
        B.market_catalog(spark, sf_dir), B.market_declared(spark, sf_dir)
    )


# --- declared schemas -------------------------------------------------------

_SHEET = """
  s AS (SELECT 'part_' || p_partkey AS t, p_brand AS c1,
      CASE WHEN p_size < 5 THEN '' ELSE 'string30' END AS t1,
      CASE WHEN p_retailprice >= 950 THEN p_type END AS c2, p_size, p_name, p_type,
      p_retailprice
    FROM part),
  cols AS (SELECT t, 0 AS ordinal, c1 AS c, t1 AS d FROM s WHERE t1 <> ''
    UNION ALL SELECT t, 1, c2, 'string200' FROM s WHERE t1 <> '' AND c2 IS NOT NULL
    UNION ALL SELECT t, 2, 'size', 'int' FROM s WHERE t1 <> '' AND c2 IS NOT NULL),
  vens AS (SELECT t, p_brand AS v FROM s JOIN part ON t = 'part_' || p_partkey
      WHERE s.p_size > 25
    UNION ALL SELECT t, p_name FROM s WHERE p_size >= 10 AND p_retailprice > 975
    UNION ALL SELECT t, p_type FROM s WHERE p_size >= 10)"""


@query(
    "sheet_columns",
    f"""WITH {_SHEET}
    SELECT t AS table_name, CAST(ordinal AS BIGINT) AS ordinal, c AS column_name,
      d AS data_type FROM cols""",
)
def sheet_columns(spark, sf_dir):
    tables = schema.sheet_columns(B.column_sheet(spark, sf_dir))
    return tables.select(
        F.col("name").alias("table_name"),
        F.posexplode("columns").alias("ordinal", "c"),
    ).select(
        "table_name",
        F.col("ordinal").cast("long").alias("ordinal"),
        F.col("c.name").alias("column_name"),
        "c.data_type",
    )


@query("sheet_vendors", f"WITH {_SHEET} SELECT t AS table_name, v AS vendor FROM vens")
def sheet_vendors(spark, sf_dir):
    return schema.declared_vendors(schema.sheet_vendors(B.vendor_sheet(spark, sf_dir)))


def _built(spark, sf_dir):
    return schema.build_tables(
        schema.sheet_columns(B.column_sheet(spark, sf_dir)),
        schema.sheet_vendors(B.vendor_sheet(spark, sf_dir)),
    )


@query(
    "build_tables",
    f"""WITH {_SHEET}
    SELECT t AS table_name, (SELECT count(*) FROM cols WHERE cols.t = s.t) AS n_columns,
      (SELECT count(*) FROM vens WHERE vens.t = s.t) AS n_vendors FROM s""",
)
def build_tables(spark, sf_dir):
    return _built(spark, sf_dir).select(
        F.col("name").alias("table_name"),
        F.size("columns").cast("long").alias("n_columns"),
        F.size("vendors").cast("long").alias("n_vendors"),
    )


@query(
    "schema_document",
    f"""WITH {_SHEET}
    SELECT s.t AS table_name, c AS column_name, d AS data_type,
      CAST(NULL AS VARCHAR) AS foreign_table FROM s LEFT JOIN cols ON cols.t = s.t""",
)
def schema_document(spark, sf_dir):
    written = schema.to_json_rows(_built(spark, sf_dir))
    return schema.declared_columns(schema.from_json_rows(written))


@query(
    "schema_document_file",
    f"""WITH {_SHEET}
    SELECT s.t AS table_name, c AS column_name, d AS data_type,
      CAST(NULL AS VARCHAR) AS foreign_table FROM s LEFT JOIN cols ON cols.t = s.t""",
)
def schema_document_file(spark, sf_dir):
    """Declared columns by way of a schema document in a file."""
    path = B.scratch(spark)
    files.write_schema_document(_built(spark, sf_dir), path)
    return schema.declared_columns(files.read_schema_document(spark, path))


# --- hierarchy --------------------------------------------------------------

_TREE = """
  leaf AS (SELECT c_custkey AS row_no, r_name AS a, n_name AS b, c_mktsegment AS c
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
  r AS (SELECT *, min(row_no) OVER (PARTITION BY a) AS r1,
      min(row_no) OVER (PARTITION BY a, b) AS r2,
      min(row_no) OVER (PARTITION BY a, b, c) AS r3 FROM leaf),
  node AS (SELECT DISTINCT a AS path, a AS name, 0 AS level, NULL AS parent, r1,
      -1 AS r2, -1 AS r3 FROM r
    UNION SELECT a || '/' || b, b, 1, a, r1, r2, -1 FROM r
    UNION SELECT a || '/' || b || '/' || c, c, 2, a || '/' || b, r1, r2, r3 FROM r)"""


def _tree(spark, sf_dir):
    rows = B.region_rows(spark, sf_dir)
    return hierarchy.tree_nodes(hierarchy.level_paths(rows, B.LEVELS, "row_no"))


def _text(path):
    return F.concat_ws("/", path)


@query(
    "level_paths",
    f"""WITH {_TREE} SELECT a || '/' || b || '/' || c AS path, row_no FROM leaf""",
)
def level_paths(spark, sf_dir):
    rows = B.region_rows(spark, sf_dir)
    paths = hierarchy.level_paths(rows, B.LEVELS, "row_no")
    return paths.select(_text("path").alias("path"), "row_no")


@query(
    "tree_nodes",
    f"""WITH {_TREE} SELECT path, name, CAST(level AS BIGINT) AS level,
      coalesce(parent, '') AS parent, greatest(r1, r2, r3) AS first_row FROM node""",
)
def tree_nodes(spark, sf_dir):
    return _tree(spark, sf_dir).select(
        _text("path").alias("path"),
        "name",
        F.col("level").cast("long").alias("level"),
        _text("parent").alias("parent"),
        "first_row",
    )


@query(
    "duplicate_nodes",
    f"""WITH {_TREE} SELECT name, count(*) AS places FROM node GROUP BY name
    HAVING count(*) > 1""",
)
def duplicate_nodes(spark, sf_dir):
    return hierarchy.duplicate_nodes(_tree(spark, sf_dir))


@query(
    "preorder",
    f"""WITH {_TREE}, o AS (SELECT *, lead(level) OVER (ORDER BY r1, r2, r3) AS next
      FROM node)
    SELECT path, name, CAST(level AS BIGINT) AS level, r1, r2, r3,
      coalesce(next > level, false) AS has_children,
      CASE WHEN next > level THEN 0 ELSE CAST(level - coalesce(next, -1) AS BIGINT) END
        AS closes FROM o""",
)
def preorder(spark, sf_dir):
    ordered = hierarchy.preorder(_tree(spark, sf_dir))
    keys_ = [
        F.coalesce(F.get("sort_key", F.lit(k)), F.lit(-1)).alias(f"r{k + 1}")
        for k in range(3)
    ]
    return ordered.select(
        _text("path").alias("path"),
        "name",
        F.col("level").cast("long").alias("level"),
        *keys_,
        "has_children",
        F.col("closes").cast("long").alias("closes"),
    )


@query(
    "outline",
    f"""WITH {_TREE} SELECT CASE WHEN level = 0 THEN name ELSE '' END AS cat_0,
      CASE WHEN level = 1 THEN name ELSE '' END AS cat_1,
      CASE WHEN level = 2 THEN name ELSE '' END AS cat_2,
      '' AS cat_3, '' AS cat_4, '' AS cat_5 FROM node""",
)
def outline(spark, sf_dir):
    rows = hierarchy.outline(hierarchy.preorder(_tree(spark, sf_dir)))
    return rows.orderBy("sort_key").drop("sort_key")


@query(
    "outline_file",
    f"""WITH {_TREE} SELECT CASE WHEN level = 0 THEN name END AS cat_0,
      CASE WHEN level = 1 THEN name END AS cat_1,
      CASE WHEN level = 2 THEN name END AS cat_2,
      CAST(NULL AS VARCHAR) AS cat_3, CAST(NULL AS VARCHAR) AS cat_4,
      CAST(NULL AS VARCHAR) AS cat_5,
      row_number() OVER (ORDER BY r1, r2, r3) AS place FROM node""",
)
def outline_file(spark, sf_dir):
    """The outline by way of its file, in the order of its lines."""
    path = B.scratch(spark)
    files.write_outline(hierarchy.preorder(_tree(spark, sf_dir)), path)
    layout = ", ".join(f"cat_{k} string" for k in range(6))
    read = files.read_load_file(spark, path, layout, "csv", "row_no")
    blank = [F.nullif(F.col(f"cat_{k}"), F.lit("")).alias(f"cat_{k}") for k in range(6)]
    return _placed(read).select(*blank, "place")


@query(
    "indented_outline",
    f"""WITH {_TREE} SELECT path, repeat('   ', level) || ' ' || name AS line FROM node""",
)
def indented_outline(spark, sf_dir):
    ordered = hierarchy.preorder(_tree(spark, sf_dir))
    lines = hierarchy.indented(ordered)
    return lines.orderBy("sort_key").select(_text("path").alias("path"), "line")


@query(
    "tree_markup",
    f"""WITH {_TREE}, o AS (SELECT *, lead(level) OVER (ORDER BY r1, r2, r3) AS next
      FROM node)
    SELECT path, '<li>' || chr(10) || '<span class="tf-nc">' || name || '</span>' || chr(10)
      || CASE WHEN next > level THEN '<ul>' || chr(10)
         ELSE '</li>' || repeat('</ul>' || chr(10) || '</li>',
           CAST(level - coalesce(next, -1) AS BIGINT)) END AS html FROM o""",
)
def tree_markup(spark, sf_dir):
    ordered = hierarchy.preorder(_tree(spark, sf_dir))
    return hierarchy.markup(ordered).select(_text("path").alias("path"), "html")


@query(
    "category_names",
    """SELECT p_size AS category_id, p_name AS category_name FROM part
    JOIN (SELECT max(p_partkey) AS m FROM part GROUP BY p_size) ON m = p_partkey""",
)
def category_names(spark, sf_dir):
    return hierarchy.category_names(_categories(spark, sf_dir), "row_no")


@query(
    "category_ids",
    """SELECT p_name AS category_name, p_size AS category_id FROM part
    JOIN (SELECT max(p_partkey) AS m FROM part GROUP BY p_name) ON m = p_partkey""",
)
def category_ids(spark, sf_dir):
    return hierarchy.category_ids(_categories(spark, sf_dir), "row_no")


def _categories(spark, sf_dir):
    return B.read(spark, sf_dir, "part").select(
        F.col("p_size").alias("category_id"),
        F.col("p_name").alias("category_name"),
        F.col("p_partkey").alias("row_no"),
    )


@query(
    "decode_levels",
    """SELECT c_custkey AS row_no, n_name AS level_1, r_name AS level_2 FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT n_nationkey AS k, n_name AS r_name FROM nation) ON k = n_regionkey""",
)
def decode_levels(spark, sf_dir):
    nations = B.read(spark, sf_dir, "nation")
    names = nations.select(
        F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name")
    )
    rows = (
        B.read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("row_no"),
            F.col("c_nationkey").alias("level_1"),
            F.col("n_regionkey").alias("level_2"),
        )
    )
    return hierarchy.decode_levels(rows, ["level_1", "level_2"], names)
