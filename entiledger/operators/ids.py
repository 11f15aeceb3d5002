"""Surrogate keys numbered without a single-task sort.

Rows fall into buckets of about equal size: ranges of a hash-drawn sample of the keys, or
ranges of a hash where rows have no key. Bucket sizes are counted, running sums of them
give the rows in front of every bucket, and a window numbers the rows inside each. The
counts are as many as the buckets, eight for each shuffle partition, however sparse the
keys are and however many rows there are.

The result depends on the rows only, so a task or a whole plan that runs again numbers
them the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import pairwise
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 8
MOST_BUCKETS = 2**15
#: Copies of a row that are unfolded at a time.
_FOLD = 2**16


def _buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(BUCKETS * parts, MOST_BUCKETS)


def key_borders(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Ascending values that cut a whole-number column into ranges of about equal size.

    The keys are dealt into as many classes as there are buckets by their hash, and the
    key of the smallest hash is drawn from each: an even sample, the same on every run,
    taken map-side in one scan. It is read now.
    """
    value, mark = F.col(key).cast("long"), F.xxhash64(F.col(key).cast("long"))
    drawn = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.pmod(mark, F.lit(buckets)).alias("_class"))
        .agg(F.min_by(value, mark).alias("_key"))
    )
    return sorted(r["_key"] for r in drawn.select("_key").collect())


def _range_of(key: Column, borders: Sequence[int]) -> Column:
    """How many borders are not above the key, by binary search; -1 without a key."""
    listed = F.split(F.lit(",".join(map(str, borders)) or "0"), ",").cast("array<bigint>")
    steps, step = [], 1
    while step <= len(borders):
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.when(key.isNull(), -1).otherwise(0)

    def on(place: Column, step: Column) -> Column:
        fits = (place + step <= len(borders)) & (F.get(listed, place + step - 1) <= key)
        return F.when(fits, place + step).otherwise(place)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), on)
    return F.when(key.isNull(), -1).otherwise(found)


def _running(order: str, parents: list[str]) -> Column:
    rows = Window.partitionBy(*parents) if parents else Window
    before = rows.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(before), F.lit(0))


def _numbered(
    df: DataFrame,
    bucket: Column,
    order: Sequence[str],
    out: str,
    first: Column,
    major: str | None = None,
) -> DataFrame:
    """df with consecutive numbers by (major, bucket, order)."""
    group = [major] if major else []
    placed = df.withColumn("_bucket", bucket)
    counts = placed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most as many rows as buckets for each major value.
    offsets = counts.select(*group, "_bucket", _running("_bucket", group).alias("_ahead"))
    if major:
        # One row for each major value.
        sums = counts.groupBy(major).agg(F.sum("_n").alias("_n"))
        ahead = sums.select(major, _running(major, []).alias("_far"))
        offsets = offsets.join(F.broadcast(ahead), major).select(
            major, "_bucket", (F.col("_far") + F.col("_ahead")).alias("_ahead")
        )
    else:
        offsets = F.broadcast(offsets)
    place = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order))
    return (
        placed.withColumn("_within", place)
        .join(offsets, [*group, "_bucket"])
        .select(*df.columns, (first + F.col("_ahead") + F.col("_within") - 1).alias(out))
    )


def dense_ids(
    df: DataFrame,
    key: str,
    out: str,
    start: int | Column = 0,
    major: str | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: consecutive numbers from ``start`` in order of ``key``.

    ``key`` is a unique integer column. With ``major``, a column of few values
    such as a table or batch ordinal, numbers run over (major, key). Rows without a key
    come first, and share one bucket: the jobs reject them. The borders of the buckets
    are read now; they change nothing in the numbers. ``keys``, a cheaper plan, may stand in
    for ``df`` when they are drawn: one with the same key column and all of its keys, so that
    no bucket gets more rows than one of these keys would.
    """
    first = F.lit(start) if isinstance(start, int) else start
    borders = key_borders(df if keys is None else keys, key, _buckets(df))
    bucket = _range_of(F.col(key).cast("long"), borders)
    return _numbered(df, bucket, [key], out, first, major)


def counted_rows(df: DataFrame, sign: int = 1) -> DataFrame:
    """The different rows, and in ``_copies`` how often each is there, times ``sign``."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.withColumn("_copies", F.col("_copies") * sign)


def lacking_rows(
    df: DataFrame, stored: DataFrame, fixed: Mapping[str, Any] | None = None
) -> DataFrame:
    """The different rows that are there more often than stored, with the ``_copies`` to add.

    A difference of multisets in one grouping, for which the rows of either side are
    shuffled once; nulls are equal to each other. Both sides have the same columns and types.
    Most rows are different, so they are counted after the shuffle only: before it, a hash
    table of all that a task reads would save nothing and spill. Copies of a row meet in one
    task, which streams them.

    ``fixed`` tells the columns of ``df`` that hold one value, not null, in all of its rows.
    Stored rows with other values there equal none of ``df``, so they are left out first, and
    these columns are not shuffled.
    """
    values = {c: F.lit(v).cast(df.schema[c].dataType) for c, v in (fixed or {}).items()}
    told = [c for c in df.columns if c not in values]
    like = reduce(Column.__and__, [F.col(c) == v for c, v in values.items()], F.lit(True))
    there = stored.where(like).select(*told, F.lit(-1).alias("_copies"))
    both = df.select(*told, F.lit(1).alias("_copies")).union(there)
    placed = both.repartition(*told) if told else both
    summed = placed.groupBy(*told).agg(F.sum("_copies").alias("_copies"))
    whole = [values[c].alias(c) if c in values else F.col(c) for c in df.columns]
    return summed.where("_copies > 0").select(*whole, "_copies")


def rows_to_add(
    df: DataFrame, stored: DataFrame, fixed: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows with the ``_copies`` to add, so that a table holds them as often as ``df``.

    An empty table lacks every row as it is: nothing is compared, so nothing is shuffled.
    ``fixed`` is passed on to :func:`lacking_rows`.
    """
    if stored.isEmpty():
        return df.withColumn("_copies", F.lit(1).cast("long"))
    return lacking_rows(df, stored, fixed)


def _placed_ids(stored: DataFrame, out: str, first: Column) -> DataFrame:
    """Rows of Parquet files with consecutive numbers by file and place in it.

    Only the rows of each file are counted, which the files' footers tell.
    """
    file = F.col("_metadata.file_path").alias("_bucket")
    counts = stored.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    # One row for each file.
    offsets = counts.select("_bucket", _running("_bucket", []).alias("_ahead"))
    columns = [c for c in stored.columns if c != out]
    placed = stored.select(*columns, file, F.col("_metadata.row_index").alias("_within"))
    number = (first + F.col("_ahead") + F.col("_within")).alias(out)
    return placed.join(F.broadcast(offsets), "_bucket").select(*columns, number)


def numbered_once(rows: DataFrame, key: str) -> bool:
    """Whether runs show that every row has a whole-number key of its own, read now.

    In a run the key grows with the row's place in its partition, so a run holds no key twice;
    nor do all of them together if their ranges don't overlap. For rows that are stored in
    order of the key, of which a file or a part of one is a run. Keys that make more runs than
    there may be buckets are not told: false.
    """
    number = F.col(key).cast("long")
    runs = (
        rows.select(number.alias("_key"), (number - F.monotonically_increasing_id()).alias("_run"))
        .groupBy("_run")
        .agg(
            F.min("_key").alias("low"),
            F.max("_key").alias("high"),
            F.count_if(F.col("_key").isNull()).alias("lacking"),
        )
    )
    found = runs.limit(MOST_BUCKETS + 1).collect()
    if len(found) > MOST_BUCKETS or any(r["lacking"] for r in found):
        return False
    ranges = sorted((r["low"], r["high"]) for r in found)
    return all(before[1] < after[0] for before, after in pairwise(ranges))


def row_ids(
    counted: DataFrame,
    out: str,
    start: int | Column = 0,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every copy of the counted rows as a row, with consecutive numbers from ``start``.

    Needs no key: rows are numbered in order of a hash of all their columns and of the
    copy's number, ranges of which are the buckets. So copies are spread as well as
    different rows, and the numbers are the same on every run.

    With ``store``, which writes rows to Parquet files and returns them as read from there,
    the copies are stored first and numbered by their places in the files: no row is
    shuffled or sorted, and the numbers are the same as long as the files stay.
    """
    columns = [c for c in counted.columns if c != "_copies"]
    first = F.lit(start) if isinstance(start, int) else start
    # In two steps, so that no array grows with the number of copies.
    folds = F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {_FOLD}"))
    copies = counted.withColumn("_fold", F.explode(folds))
    last = F.least(F.col("_copies") - F.col("_fold") * _FOLD, F.lit(_FOLD)) - 1
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    if store is not None:
        return _placed_ids(store(copies.select(*columns)), out, first)
    mark = F.xxhash64("_fold", "_copy", *columns)
    copies = copies.withColumn("_mark", mark).drop("_copies")
    bits = (_buckets(counted) - 1).bit_length()
    order = ["_mark", "_fold", "_copy", *columns]
    done = _numbered(copies, F.shiftright("_mark", 64 - bits), order, out, first)
    return done.select(*columns, out)


def next_id(table: DataFrame, column: str, default: int) -> Column:
    """First free id of a table as a scalar subquery: its highest id plus one.

    Ids never start anywhere else, so loaded entities cannot meet migrated ones.
    """
    return F.coalesce(table.agg(F.max(column)).scalar() + 1, F.lit(default)).cast(
        "long"
    )


def first_free(default: int, *ids: DataFrame) -> int:
    """First number above all ids of the given one-column tables, read now.

    The default holds only where there are no ids at all.
    """
    highest = [df.agg(F.max(df.columns[0])).first()[0] for df in ids]
    return max([h + 1 for h in highest if h is not None], default=default)
