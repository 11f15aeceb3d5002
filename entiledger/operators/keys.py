"""Membership tests, duplicate checks and foreign-key remapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiledger.model import BAD_KEY_SENTINEL
from entiledger.operators.joins import fits_broadcast, hot_values, lookup_join

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)

# The columns that a value of any type takes, one of them filled.
VALUE_COLUMNS = ["num", "dbl", "txt"]


def members(
    rows: DataFrame,
    column: str,
    keys: DataFrame,
    key: str,
) -> DataFrame:
    """Rows whose column value is among the keys."""
    wanted = keys.select(F.col(key).alias(column)).distinct()
    return lookup_join(rows, wanted, column, "inner").select(*rows.columns)


def non_members(
    rows: DataFrame,
    column: str,
    keys: DataFrame,
    key: str,
) -> DataFrame:
    """Rows a SQL ``NOT IN`` keeps; the keys themselves are unique and not null.

    A null value is not kept, unless there are no keys at all.
    """
    known = keys.select(F.col(key).alias(column), F.lit(True).alias("_known"))
    joined = lookup_join(rows, known, column, "left")
    no_keys = keys.agg(F.count(F.lit(1)) == 0).scalar()
    kept = F.col("_known").isNull() & (F.col(column).isNotNull() | no_keys)
    return joined.where(kept).select(*rows.columns)


def column_values(df: DataFrame, column: str | None) -> list[Column]:
    """A column as three: ``num`` for integers, ``dbl`` for floating numbers, ``txt``.

    Values of different tables and columns so share one table without turning numbers
    into text, and ``0.0`` and ``-0.0`` stay one value. No column gives nulls.
    """
    kind = df.schema[column].dataType if column else None
    none = F.lit(None)
    value = F.col(column) if column else none
    whole, floating = isinstance(kind, _WHOLE), isinstance(kind, _FLOATING)
    return [
        (value if whole else none).cast("long").alias("num"),
        (value if floating else none).cast("double").alias("dbl"),
        (none if whole or floating else value).cast("string").alias("txt"),
    ]


def duplicate_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct values that occur more than once, per column.

    Each column is scanned by itself and one shuffle serves all. Nulls never count.
    """
    values = reduce(
        DataFrame.unionByName,
        [
            df.where(F.col(c).isNotNull()).select(
                F.lit(place).alias("place"), *column_values(df, c)
            )
            for place, c in enumerate(columns)
        ],
    )
    counted = values.groupBy("place", *VALUE_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    repeated = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if((F.col("place") == place) & (F.col("n") > 1)).alias("duplicates"),
        )
        for place, c in enumerate(columns)
    ]
    return counted.agg(F.array(*repeated).alias("t")).select(F.inline("t"))


def one_to_one(df: DataFrame, id_column: str, ext_column: str) -> DataFrame:
    """Duplicate counts of both sides of an id map, as one row.

    Both are null when either column is missing.
    """
    if id_column not in df.columns or ext_column not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("dup_ids"),
            F.lit(None).cast("long").alias("dup_ext_ids"),
        )
    counts = duplicate_values(df, [id_column, ext_column])

    def of(column: str, out: str):
        return F.max(F.when(F.col("column_name") == column, F.col("duplicates"))).alias(
            out
        )

    return counts.agg(of(id_column, "dup_ids"), of(ext_column, "dup_ext_ids"))


def _bridge_for(bridge: DataFrame, thing: str, fk: str) -> DataFrame:
    return bridge.where(F.col("thing") == thing).select(
        F.col("old_id").cast("long").alias(fk), F.col("n_id").alias("_new")
    )


def _remapped(
    fk: str, new: Column, keys: DataFrame, sentinel: int | None
) -> list[Column]:
    """The remapped key and its flag, or with a sentinel the key alone."""
    old = F.col(fk).cast("long")
    if sentinel is None:
        return [new.alias(fk), (old.isNotNull() & new.isNull()).alias(f"bad_{fk}")]
    known = keys.where(F.col(fk) == sentinel).agg(F.max("_new")).scalar()
    no_keys = keys.agg(F.count(F.lit(1)) == 0).scalar()
    replaced = F.coalesce(known, F.lit(sentinel).cast("long"))
    value = F.when(new.isNotNull(), new).when(old.isNotNull() | no_keys, replaced)
    return [value.alias(fk)]


def remap_foreign_key(
    rows: DataFrame,
    fk: str,
    foreign_table: str,
    bridge: DataFrame,
    sentinel: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Replace an old foreign key by the new id that the bridge gives.

    A key that the bridge does not know becomes null and is flagged in
    ``bad_<fk>``. With ``sentinel`` such a key takes that value first and is then
    remapped like any other, as the former rule did; no flag is added.
    ``hot`` is passed on to the lookup join.
    """
    keys = _bridge_for(bridge, foreign_table, fk)
    cast = rows.withColumn(fk, F.col(fk).cast("long"))
    spread = ["log_id"] if "log_id" in rows.columns else None
    joined = lookup_join(cast, keys, fk, "left", spread, hot=hot)
    key, *flag = _remapped(fk, F.col("_new"), keys, sentinel)
    return joined.select(*[key if c == fk else F.col(c) for c in rows.columns], *flag)


def _looked_up(
    rows: DataFrame, foreign_keys: Mapping[str, str], bridge: DataFrame, row_key: list[str]
) -> DataFrame:
    """Rows with the new id of each foreign key, in ``_new_<fk>``, by one lookup for all.

    Only the row's key and one value travel to the bridge, a row for each foreign key that
    is there; the wide rows are shuffled once, by their own key.
    """
    each = F.array(
        *[
            F.struct(
                F.lit(fk).alias("_fk"),
                F.lit(table).alias("thing"),
                F.col(fk).cast("long").alias("old_id"),
            )
            for fk, table in foreign_keys.items()
        ]
    )
    pairs = rows.select(*row_key, F.inline(each)).where(F.col("old_id").isNotNull())
    known = bridge.select("thing", F.col("old_id").cast("long").alias("old_id"), "n_id")
    found = lookup_join(pairs, known, ["thing", "old_id"], "inner", row_key)
    news = [
        F.max(F.when(F.col("_fk") == fk, F.col("n_id"))).alias(f"_new_{fk}")
        for fk in foreign_keys
    ]
    return rows.join(found.groupBy(*row_key).agg(*news), row_key, "left")


def remap_foreign_keys(
    rows: DataFrame,
    foreign_keys: Mapping[str, str],
    bridge: DataFrame,
    known_tables: list[str],
    use_sentinel: bool = False,
    skip_after_unknown: bool = False,
    row_key: Sequence[str] = ("log_id",),
) -> DataFrame:
    """Remap every foreign key of a table, given as column -> foreign table.

    An unknown foreign table is an error; with ``skip_after_unknown`` that key and
    the later ones are left as they are. Run it once per table: a second run would
    take new ids for old ones.

    A bridge that Spark itself would broadcast is joined key by key without a shuffle.
    Otherwise several keys of rows with a unique ``row_key`` share one lookup, and rows
    without one are joined key by key, the hot values of all keys coming from one scan.
    """
    taken: dict[str, str] = {}
    for fk, foreign_table in foreign_keys.items():
        if foreign_table not in known_tables:
            if skip_after_unknown:
                break
            raise ValueError(f"column {fk}: unknown foreign table {foreign_table!r}")
        taken[fk] = foreign_table
    sentinel = BAD_KEY_SENTINEL if use_sentinel else None
    columns = list(rows.columns)
    keyed = set(row_key) <= set(columns) and not set(row_key) & set(taken)
    if len(taken) > 1 and keyed and not fits_broadcast(bridge):
        joined = _looked_up(rows, taken, bridge, list(row_key))
        parts = {
            fk: _remapped(
                fk, F.col(f"_new_{fk}"), _bridge_for(bridge, table, fk), sentinel
            )
            for fk, table in taken.items()
        }
        keys = [parts[c][0] if c in parts else F.col(c) for c in columns]
        return joined.select(*keys, *[flag for fk in taken for flag in parts[fk][1:]])
    hot = hot_values(rows, list(taken)) if taken else {}
    for fk, foreign_table in taken.items():
        rows = remap_foreign_key(rows, fk, foreign_table, bridge, sentinel, hot[fk])
    return rows


def integrity_report(
    rows: DataFrame,
    primary_key: list[str],
    not_null: list[str] = (),
    max_length: Mapping[str, int] | None = None,
    domains: Mapping[str, list[str]] | None = None,
    foreign_keys: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Violations per rule as (rule, column_name, violations).

    Row rules share one scan. ``foreign_keys`` maps a column to a one-column table
    of valid keys. ``primary_key`` counts key values used more than once; without columns
    the rule is left out.
    """
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [
        ("max_length", c, F.char_length(c) > n) for c, n in (max_length or {}).items()
    ]
    checks += [
        ("domain", c, ~F.col(c).isin(list(v))) for c, v in (domains or {}).items()
    ]
    parts = []
    if checks:
        totals = rows.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"),
                        F.lit(column).alias("column_name"),
                        F.count_if(test).alias("violations"),
                    )
                    for rule, column, test in checks
                ]
            ).alias("t")
        )
        parts.append(totals.select(F.inline("t")))
    if primary_key:
        repeated = rows.groupBy(*primary_key).count().where(F.col("count") > 1)
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit("primary_key").alias("rule"),
                F.lit(", ".join(primary_key)).alias("column_name"),
                "violations",
            )
        )
    for column, keys in (foreign_keys or {}).items():
        # Counting per value first leaves one row per value for the join.
        used = rows.where(F.col(column).isNotNull()).groupBy(column).count()
        valid = keys.toDF(column)
        missing = used.join(valid, column, "left_anti")
        parts.append(
            missing.agg(
                F.coalesce(F.sum("count"), F.lit(0)).alias("violations")
            ).select(
                F.lit("foreign_key").alias("rule"),
                F.lit(column).alias("column_name"),
                "violations",
            )
        )
    return reduce(DataFrame.unionByName, parts)
