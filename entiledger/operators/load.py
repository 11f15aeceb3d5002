"""Loads of change files: new entities, or new versions of known ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.model import FIRST_N_ID, STATUS_CODES
from entiledger.operators.ids import dense_ids, first_free


@dataclass(frozen=True)
class Load:
    """Outcome of a load.

    ``rows`` are the versions to append, ``new_things`` the registry rows to append
    before them, ``errors`` the reasons why batches were rejected. All three stay what
    they are when the registry grows. ``logged`` is the number of log ids they take up.
    """

    rows: DataFrame
    new_things: DataFrame
    errors: DataFrame
    logged: int = 0


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def reference_errors(
    rows: DataFrame, registry: DataFrame, thing: str, start: int | None = None
) -> DataFrame:
    """Ids in modifying rows that are missing, unknown or belong to another thing.

    Rows are counted per batch and id first, so an id with very many rows is one
    row in the join, and both of its sides are close to unique on the id. A batch also
    knows the ids that earlier ones of the series create: with ``start``, those from
    there up to its ``_ends``.
    """
    ends = F.max("_ends") if start is not None else F.lit(None).cast("long")
    used = rows.groupBy("batch_no", "n_id").agg(
        F.count(F.lit(1)).alias("n_rows"), ends.alias("_ends")
    )
    known = registry.select("n_id", F.col("thing").alias("found"))
    created = F.lit(False)
    if start is not None:
        created = (F.col("n_id") >= start) & (F.col("n_id") < F.col("_ends"))
    found = F.coalesce(F.col("found"), F.when(created, thing))
    problem = (
        F.when(F.col("n_id").isNull(), "missing")
        .when(F.col("found").isNull(), "unknown")
        .when(F.col("found") != thing, "wrong_thing")
    )
    return (
        used.join(known, "n_id", "left")
        .withColumn("found", found)
        .select("batch_no", "n_id", "found", problem.alias("problem"), "n_rows")
        .where(F.col("problem").isNotNull())
    )


def _bad_status(batch: DataFrame) -> Column:
    """Whether a row's status is none of the known ones; a null is none at all."""
    if "status" not in batch.columns:
        return F.lit(False)
    return F.coalesce(~F.col("status").isin(list(STATUS_CODES)), F.lit(False))


def status_errors(rows: DataFrame) -> DataFrame:
    """Status values of batches that are outside the enumeration, with their rows."""
    return (
        rows.where(_bad_status(rows))
        .groupBy("batch_no", F.col("status").cast("string").alias("found"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            "batch_no",
            F.lit(None).cast("long").alias("n_id"),
            "found",
            F.lit("status").alias("problem"),
            "n_rows",
        )
    )


@dataclass(frozen=True)
class Series:
    """Batches as one table, told apart by ``batch_no`` from 1.

    ``creates`` tells of each batch whether its rows create entities; the others have the
    ids of those that they modify in ``n_id``.
    """

    rows: DataFrame
    creates: list[bool]


def series_of(batches: Sequence[DataFrame]) -> Series:
    """Batches of any columns as a series; one with an ``n_id`` column modifies."""
    creates = ["n_id" not in batch.columns for batch in batches]
    parts = [
        batch.withColumn("batch_no", F.lit(place))
        for place, batch in enumerate(batches, start=1)
    ]
    return Series(_union(parts), creates)


def _counted(rows: DataFrame, row_no: str) -> dict[int, tuple]:
    """(rows, rows with a number, rows of a bad status) of each batch, in one scan."""
    counts = rows.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(row_no).alias("numbered"),
        F.count_if(_bad_status(rows)).alias("bad"),
    )
    # One row per batch of the series.
    return {r.batch_no: (r.n, r.numbered, r.bad) for r in counts.collect()}


def load_series(
    batches: Sequence[DataFrame] | Series,
    registry: DataFrame,
    thing: str,
    row_no: str,
    next_default: int = FIRST_N_ID,
    first_log_id: int | None = None,
    start: int | None = None,
) -> Load:
    """Load batches in order, each one whole or not at all.

    A batch with an ``n_id`` column modifies known entities; one without creates
    entities with the next free ids, in order of batch and ``row_no``, a unique
    integer per batch. A batch that refers to ids it must not change or has a status
    outside the enumeration is rejected; that does not stop the later ones.

    With ``first_log_id`` the rows get log ids in the same order; a rejected batch
    leaves a gap in them. ``start`` is the first new id, otherwise read from the
    registry. Batches are counted here, which fixes all numbers of the planned rows.
    A :class:`Series` that comes from one source is scanned as often whether it has one
    batch or thousands.
    """
    series = batches if isinstance(batches, Series) else series_of(batches)
    given, spark = series.rows, registry.sparkSession
    if start is None:
        start = first_free(next_default, registry.select("n_id"))
    counts = _counted(given, row_no)
    # Where each batch's new ids and log ids start, counted from the first ones, and how
    # many rows the batches in front of it have that are not rejected for their status.
    places, made, logged, taken, changes, wrong = [], 0, 0, 0, False, False
    for place, creates in enumerate(series.creates, start=1):
        n, numbered, bad = counts.get(place, (0, 0, 0))
        if numbered < n:
            raise ValueError(f"batch {place}: rows without a {row_no}")
        places.append((place, creates, not bad, logged - taken, made - taken, start + made))
        wrong = wrong or bad > 0
        changes = changes or not (creates or bad)
        made += n if creates and not bad else 0
        taken += 0 if bad else n
        logged += n
    # One row per batch.
    kinds = "batch_no int, _creates boolean, _taken boolean, _log long, _new long, _ends long"
    known = F.broadcast(spark.createDataFrame(places, kinds))
    if "n_id" not in given.columns:
        given = given.withColumn("n_id", F.lit(None).cast("long"))
    placed = given.join(known, "batch_no")
    found = []
    if changes:
        changed = placed.where("_taken AND NOT _creates").select(
            "batch_no", F.col("n_id").cast("long").alias("n_id"), "_ends"
        )
        registered = registry.where(F.col("n_id") < start)
        errors = reference_errors(changed, registered, thing, start)
        found.append(errors)
    if wrong:
        found.append(status_errors(placed))
    errors = (
        _union(found)
        if found
        else spark.createDataFrame(
            [], "batch_no int, n_id long, found string, problem string, n_rows long"
        )
    )
    new_things = spark.range(start, start + made).select(
        F.col("id").alias("n_id"), F.lit(thing).alias("thing")
    )
    others = [c for c in given.columns if c not in ("batch_no", "n_id")]
    rows = placed.where("_taken").select(
        "batch_no",
        "_log",
        "_new",
        F.when(~F.col("_creates"), F.col("n_id")).cast("long").alias("n_id"),
        *others,
        F.when(F.col("_creates"), "create").otherwise("modify").alias("action"),
    )
    if made or first_log_id is not None:
        rows = dense_ids(rows, row_no, "_place", 0, "batch_no")
        new_id = F.when(F.col("action") == "create", start + F.col("_new") + F.col("_place"))
        rows = rows.withColumn("n_id", F.coalesce(new_id, F.col("n_id")))
        if first_log_id is not None:
            rows = rows.withColumn("log_id", first_log_id + F.col("_log") + F.col("_place"))
        rows = rows.drop("_place")
    rows = rows.drop("_log", "_new")
    if changes:
        # At most one row per batch.
        wrong_ids = F.broadcast(errors.select("batch_no").distinct())
        rows = rows.join(wrong_ids, "batch_no", "left_anti")
    return Load(rows, new_things, errors, logged)


def load_rows(
    rows: DataFrame,
    registry: DataFrame,
    thing: str,
    row_no: str,
    next_default: int = FIRST_N_ID,
    first_log_id: int | None = None,
) -> Load:
    """Load a single batch; see :func:`load_series`."""
    return load_series([rows], registry, thing, row_no, next_default, first_log_id)
