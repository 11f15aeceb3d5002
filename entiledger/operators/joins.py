"""Lookup joins that keep their shape when a key is hot.

A lookup joins many rows to a side that has at most one row per key. A key may
hold a large share of the rows, so a plain shuffle join could send that share to
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than one in so many parts of a mean shuffle partition's
# rows. So there are at most eight times as many hot keys as partitions, however large
# the table is, and the pieces are small enough for chance to deal them out evenly.
PIECES = 8
#: Classes for each part of the rows among which hot keys are looked for.
_CLASSES = 8


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast a side, by its own estimate in bytes."""
    plan = df._jdf.queryExecution().optimizedPlan()
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = int(str(plan.stats().sizeInBytes()))
    return size <= conf.autoBroadcastJoinThreshold()


def id_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join two sides that hold about one row per id, however many ids there are.

    Both are always shuffled. Spark takes a side's size from its files, where ids are packed
    to an eighth or less of what they take in the hash table that the driver builds of a
    broadcast side, and several of them are built at a time.
    """
    return left.join(right.hint("merge"), on, how)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _hot(
    counts: DataFrame, by: list[str], parts: int, total: Column | None = None
) -> DataFrame:
    """Keys with over 1 / parts of the rows, and how many salts each is given."""
    if total is None:
        total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * parts > total).select(
        *by, F.ceil(F.col("_n") * parts / total).cast("int").alias("_salts")
    )


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Hot keys of a table with their number of salts.

    A table whose keys are evenly used has none. Classes of keys are counted first, by a
    hash; only in one that has a hot key's rows or more can there be one, and only the keys
    of such classes are counted each by itself.
    """
    parts = PIECES * _partitions(rows)
    mark = F.pmod(F.xxhash64(*keys), F.lit(_CLASSES * parts)).alias("_class")
    known = rows.select(*keys).na.drop(subset=keys).select(*keys, mark)
    count = F.count(F.lit(1)).alias("_n")
    classes = known.groupBy("_class").agg(count)
    total = classes.agg(F.sum("_n")).scalar()
    # Fewer than the parts.
    full = classes.where(F.col("_n") * parts > total).select("_class")
    few = known.join(F.broadcast(full), "_class", "left_semi")
    return _hot(few.groupBy(*keys).agg(count), keys, parts, total)


def hot_values(rows: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Hot values of several whole-number columns, all counted in one scan."""
    each = F.array(
        *[F.struct(F.lit(c).alias("_c"), F.col(c).cast("long").alias("_v")) for c in columns]
    )
    listed = rows.select(F.inline(each)).where(F.col("_v").isNotNull())
    counts = listed.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    parts = PIECES * _partitions(rows)
    out = {}
    for c in columns:
        own = counts.where(F.col("_c") == c).select(F.col("_v").alias(c), "_n")
        out[c] = _hot(own, [c], parts)
    return out


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    profile: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which is unique on the key columns.

    A lookup side that Spark would broadcast by its size in bytes is joined as it is.
    Otherwise every hot key of ``rows`` is spread over as many tasks as its share asks
    for, with the lookup row repeated as often. Null keys, which match nothing, are
    spread as well.

    ``profile`` stands in for ``rows`` when hot keys are looked for: a cheaper plan with
    the same key columns, such as the table before other joins. ``hot`` gives them, if
    they are known, as :func:`hot_keys` does.

    The salt comes from the partition and the optional ``spread`` columns, so a task
    that runs again gives every row the same salt.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError(f"a lookup join is inner or left, not {how!r}")
    if fits_broadcast(lookup):
        return rows.join(lookup, keys, how)
    if hot is None:
        hot = hot_keys(rows if profile is None else profile, keys)
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    salt = F.spark_partition_id()
    if spread:
        salt = salt + F.xxhash64(*[F.col(c) for c in spread])
    salts = F.when(no_key, _partitions(rows)).otherwise(F.coalesce("_salts", F.lit(1)))
    # At most eight times as many rows as partitions.
    known = F.broadcast(hot)
    salted = (
        rows.join(known, keys, "left")
        .withColumn("_salt", F.pmod(salt, salts).cast("int"))
        .drop("_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = (
        lookup.join(known, keys, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_salts")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
