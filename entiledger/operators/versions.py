"""Change-log queries: filters, newest version per entity, synthetic versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiledger.functions.columns import numbered_name, shifted_day, stepped_status
from entiledger.model import ACTION_CODES, STATUS_CODES
from entiledger.operators.ids import dense_ids
from entiledger.operators.joins import lookup_join


def filter_log(
    log: DataFrame,
    status: str | None = None,
    action: str | None = None,
    n_id: int | None = None,
) -> DataFrame:
    """Keep rows that meet every given condition; a condition of None is skipped."""
    if status is not None and status not in STATUS_CODES:
        raise ValueError(f"unknown status {status!r}")
    if action is not None and action not in ACTION_CODES:
        raise ValueError(f"unknown action {action!r}")
    for column, wanted in (("status", status), ("action", action), ("n_id", n_id)):
        if wanted is not None:
            log = log.where(F.col(column) == wanted)
    return log


def newest_per_entity(log: DataFrame, group: Sequence[str] = ("n_id",)) -> DataFrame:
    """Row with the highest ``log_id`` of each ``n_id``, or of each group.

    Spark keeps one row per entity and input partition before the shuffle, so an
    entity with very many versions costs no more than any other.
    """
    newest_first = Window.partitionBy(*group).orderBy(F.desc("log_id"))
    return (
        log.withColumn("_place", F.row_number().over(newest_first))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def query_log(
    log: DataFrame,
    status: str | None = None,
    action: str | None = None,
    n_id: int | None = None,
    latest: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Filter a change log and optionally keep the newest of the rows left.

    The newest version is taken among the filtered rows, so an entity appears
    with its last version that meets the conditions. Deleted entities stay.
    """
    rows = filter_log(log, status, action, n_id)
    if latest:
        rows = newest_per_entity(rows)
    return rows.orderBy("created_ts", "log_id") if ordered else rows


def newest_ids(log: DataFrame) -> DataFrame:
    """Highest ``log_id`` and latest ``created_ts`` per entity."""
    return log.groupBy("n_id").agg(
        F.max("log_id").alias("max_log_id"), F.max("created_ts").alias("max_created_ts")
    )


def last_names(log: DataFrame) -> DataFrame:
    """Name of each entity in its newest version."""
    return log.groupBy("n_id").agg(F.max_by("name", "log_id").alias("name"))


def amplify(
    log: DataFrame,
    copies: int,
    own_name: bool = False,
    keep_status: bool = False,
) -> DataFrame:
    """Synthetic ``modify`` versions: ``copies`` per row of a change log.

    Copy ``i`` is ``i + 1`` days later and carries the entity's last name, or the
    row's own with ``own_name``, with ``-i`` behind it. New log ids follow the
    highest one without gaps, copy by copy in the order of the copied rows, so they
    grow by no more than the new rows however often this is done.
    """
    base = dense_ids(log, "log_id", "_place")
    if not own_name:
        base = lookup_join(
            base.drop("name"), last_names(log), "n_id", "inner", ["log_id"], log
        )
    span = log.agg(
        F.struct(F.count("log_id").alias("n"), F.max("log_id").alias("high"))
    ).scalar()
    index = F.col("_copy")
    log_id = span.getField("high") + 1 + index * span.getField("n") + F.col("_place")
    indexes = F.sequence(F.lit(0), F.lit(max(copies, 1) - 1))
    if copies < 1:
        indexes = F.array().cast("array<int>")
    changed = {
        "log_id": log_id,
        "action": F.lit("modify"),
        "created_ts": shifted_day(F.col("created_ts"), index),
        "name": numbered_name(F.col("name"), index),
    }
    if not keep_status:
        changed["status"] = stepped_status(F.col("status"), index)
    return base.withColumn("_copy", F.explode(indexes)).select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in log.columns]
    )
