"""Checks of legacy tables: which exist, how they are built, what they hold."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.functions.columns import (
    bare_table_name,
    is_standard_column,
    legacy_type,
    table_name,
)
from entiledger.operators.keys import VALUE_COLUMNS, column_values

# Accepted types of the required columns.
TEXT_TYPES = ["TEXT", "VARCHAR(200)"]
ID_TYPES = ["INTEGER", "BIGINT"]
TIME_TYPES = ["TIMESTAMP"]

# Actions whose tables map ids of a vendor.
MAPPING_ACTIONS = ("map", "fuzzymatch")

def _listed(names: list[str | None]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def enumerate_tables(
    names: DataFrame, things: list[str], vendors: list[str], actions: list[str]
) -> DataFrame:
    """Tables of ``names`` that belong to a listed thing, in report order.

    ``names`` has one column ``table_name``. Per thing come its own table, its
    action tables, then its vendor tables by vendor and action. A thing without
    its own table is skipped together with its other tables.
    """
    # A leading null stands for "no vendor" and "no action"; its ordinal is -1.
    place = F.col("place") - 1
    candidates = (
        names.sparkSession.range(0, 1, 1, 1)
        .select(F.posexplode(_listed(things)).alias("thing_ord", "thing"))
        .select("*", F.posexplode(_listed([None, *vendors])).alias("place", "vendor"))
        .withColumn("vendor_ord", place)
        .drop("place")
        .select("*", F.posexplode(_listed([None, *actions])).alias("place", "action"))
        .withColumn("action_ord", place)
        .where(F.col("vendor").isNull() | F.col("action").isNotNull())
        .withColumn(
            "table_name", table_name(F.col("thing"), F.col("action"), F.col("vendor"))
        )
    )
    present = names.select(bare_table_name(F.col("table_name")).alias("table_name"))
    found = candidates.join(present.distinct(), "table_name")
    with_table = found.where(F.col("action").isNull() & F.col("vendor").isNull())
    return found.join(with_table.select("thing_ord"), "thing_ord", "left_semi").select(
        "thing_ord", "vendor_ord", "action_ord", "table_name", "thing", "action", "vendor"
    )


def has_column(labels: list[Column], types: list[str]) -> Column:
    """Aggregate: some column has one of the labels and one of the types."""
    named = reduce(lambda a, b: a | b, [F.col("column_name") == x for x in labels])
    typed = legacy_type(F.col("data_type")).isin(types)
    return F.coalesce(F.bool_or(named & typed), F.lit(False))


def _label(suffix: str) -> Column:
    return F.concat(F.col("thing"), F.lit(suffix))


def column_checks(
    tables: DataFrame, catalog: DataFrame, ext_labels: list[str] = ("ext_id",)
) -> DataFrame:
    """Outcome of the column rules per table.

    A check that a kind of table is not expected to pass is null. ``tables`` comes
    from :func:`enumerate_tables`; ``catalog`` has one row per column.
    """
    columns = catalog.select(
        bare_table_name(F.col("table_name")).alias("table_name"),
        "column_name",
        "data_type",
    )
    has_log = (
        has_column([F.lit("created_ts")], TIME_TYPES)
        & has_column([F.lit("updated_ts")], TIME_TYPES)
        & has_column([F.lit("created_by")], TEXT_TYPES)
        & has_column([F.lit("updated_by")], TEXT_TYPES)
    )
    keys = ["table_name", "thing", "action", "vendor"]
    found = (
        tables.join(columns, "table_name", "left")
        .groupBy(*keys, "thing_ord", "vendor_ord", "action_ord")
        .agg(
            has_column([_label("_id")], ID_TYPES).alias("_id"),
            has_column([_label("_name"), F.col("thing")], TEXT_TYPES).alias("_name"),
            has_log.alias("_log"),
            has_column([F.lit(x) for x in ext_labels], TEXT_TYPES).alias("_ext"),
            F.count("column_name").alias("columns"),
            F.coalesce(
                F.bool_or(F.col("column_name") == _label("_id")), F.lit(False)
            ).alias("_any_id"),
            F.coalesce(F.bool_or(F.col("column_name") == "ext_id"), F.lit(False)).alias(
                "_any_ext"
            ),
        )
    )
    own = F.col("action").isNull()
    vended = F.col("vendor").isNotNull()
    mapping = F.col("action").isin(*MAPPING_ACTIONS)
    mapped = vended & mapping
    imported = vended & (F.col("action") == "import")
    keyed = own | mapped
    named = own | (~own & ~vended) | imported
    return found.select(
        "thing_ord",
        "vendor_ord",
        "action_ord",
        *keys,
        F.when(keyed, F.col("_id")).alias("good_id"),
        F.when(named, F.col("_name")).alias("good_name"),
        F.when(keyed, F.col("_log")).alias("good_log"),
        F.when(mapping, F.col("_ext")).alias("good_ext"),
        "columns",
        (F.coalesce(mapped, F.lit(False))).alias("maps_ids"),
        (F.col("_any_id") & F.col("_any_ext")).alias("has_ids"),
    )


def profile_tables(
    tables: Mapping[str, DataFrame], id_columns: Mapping[str, str]
) -> DataFrame:
    """Rows and duplicate counts of many tables in one shuffle.

    ``id_columns`` gives the id column of every id-map table, whose duplicates of
    that column and of ``ext_id`` are counted. Tables without rows are absent.
    """
    names = list(tables)
    slim = []
    for place, name in enumerate(names):
        df = tables[name]
        id_column = id_columns.get(name)
        mapped = id_column in df.columns and "ext_id" in df.columns
        # Both sides of an id map come from one scan.
        sides = [(False, id_column if mapped else None)]
        sides += [(True, "ext_id")] if mapped else []
        values = [
            F.struct(F.lit(ext).alias("ext"), *column_values(df, column))
            for ext, column in sides
        ]
        slim.append(
            df.select(F.inline(F.array(*values))).select(
                F.lit(place).alias("place"), "ext", *VALUE_COLUMNS
            )
        )
    counted = (
        reduce(DataFrame.unionByName, slim)
        .groupBy("place", "ext", *VALUE_COLUMNS)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    repeated = F.coalesce(*[F.col(c).cast("string") for c in VALUE_COLUMNS]).isNotNull()
    repeated &= F.col("n") > 1
    totals = counted.groupBy("place").agg(
        F.sum(F.when(~F.col("ext"), F.col("n"))).alias("rows"),
        F.count_if(~F.col("ext") & repeated).alias("dup_id"),
        F.count_if(F.col("ext") & repeated).alias("dup_ext_id"),
    )
    named = F.get(_listed(names), F.col("place"))
    return totals.select(named.alias("table_name"), "rows", "dup_id", "dup_ext_id")


def report_position(tables: DataFrame, n_vendors: int, n_actions: int) -> Column:
    """Sortable position of a table in the report; it has gaps."""
    vendor_place = F.col("vendor_ord").cast("long") + 1
    action_place = F.col("action_ord").cast("long") + 1
    per_thing = (n_vendors + 1) * (n_actions + 1)
    return F.col("thing_ord") * per_thing + vendor_place * (n_actions + 1) + action_place


def column_rules(
    catalog: DataFrame, things: list[str], vendors: list[str], actions: list[str]
) -> DataFrame:
    """One row per legacy table: the outcome of every column rule, from the catalog."""
    known = catalog.select("table_name").distinct()
    listed = enumerate_tables(known, things, vendors, actions)
    checks = column_checks(listed, catalog)
    return checks.select(
        report_position(checks, len(vendors), len(actions)).alias("position"),
        "table_name",
        "good_id",
        "good_name",
        "good_log",
        "good_ext",
        "columns",
    )


def validation_report(
    tables: Mapping[str, DataFrame],
    catalog: DataFrame,
    things: list[str],
    vendors: list[str],
    actions: list[str],
) -> DataFrame:
    """One row per legacy table: column checks, row count and duplicate counts."""
    bare = {name.split(".")[-1]: df for name, df in tables.items()}
    known = catalog.select("table_name").distinct()
    listed = enumerate_tables(known, things, vendors, actions)
    checks = column_checks(listed, catalog)
    id_columns = {
        f"{action}_{thing}_{vendor}": f"{thing}_id"
        for action in MAPPING_ACTIONS
        for thing in things
        for vendor in vendors
    }
    profile = profile_tables(bare, id_columns)
    countable = ~F.col("maps_ids") | F.col("has_ids")

    def duplicates(column: str) -> Column:
        found = F.when(F.col("maps_ids"), F.col(column)).otherwise(0)
        return F.when(countable, F.coalesce(found, F.lit(0)))

    return checks.join(profile, "table_name", "left").select(
        report_position(checks, len(vendors), len(actions)).alias("position"),
        "table_name",
        "thing",
        "action",
        "vendor",
        "good_id",
        "good_name",
        "good_log",
        "columns",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        duplicates("dup_id").alias("dup id"),
        duplicates("dup_ext_id").alias("dup ext_id"),
    )


def schema_difference(catalog: DataFrame, declared: DataFrame) -> DataFrame:
    """Legacy columns that are neither standard nor declared for their table.

    ``declared`` has one row per declared column, and a row with a null column for
    a table without any. Tables that only one side knows are ignored.
    """
    columns = catalog.select(
        bare_table_name(F.col("table_name")).alias("table_name"),
        "column_name",
        "data_type",
    )
    extra = columns.where(
        ~is_standard_column(F.col("table_name"), F.col("column_name"))
    )
    known = declared.select("table_name").distinct()
    named = declared.where(F.col("column_name").isNotNull()).select(
        "table_name", "column_name"
    )
    return extra.join(known, "table_name", "left_semi").join(
        named, ["table_name", "column_name"], "left_anti"
    )
