"""Scalar column expressions: enumerations, names, versions, column classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entiledger.model import ACTION_CODES, LEGACY_PREFIX, LOG_COLUMNS, STATUS_CODES


def _lookup(pairs, value: Column) -> Column:
    entries = [F.lit(part) for pair in pairs for part in pair]
    return F.try_element_at(F.create_map(*entries), value)


def status_code(text: Column) -> Column:
    """Status text to its code; unknown text gives null."""
    return _lookup(STATUS_CODES.items(), text)


def status_name(code: Column) -> Column:
    """Status code to its text; an unknown code gives null."""
    return _lookup([(v, k) for k, v in STATUS_CODES.items()], code)


def action_code(text: Column) -> Column:
    """Action text to its code; unknown text gives null."""
    return _lookup(ACTION_CODES.items(), text)


def action_name(code: Column) -> Column:
    """Action code to its text; an unknown code gives null."""
    return _lookup([(v, k) for k, v in ACTION_CODES.items()], code)


def numbered_name(name: Column, index: Column) -> Column:
    """Name of a synthetic version: the base name, a dash and the copy's index."""
    return F.concat(name, F.lit("-"), index.cast("string"))


def shifted_day(ts: Column, index: Column) -> Column:
    """Timestamp of a synthetic version: one day later per copy."""
    return ts + F.make_dt_interval(index.cast("int") + 1)


def stepped_status(status: Column, index: Column) -> Column:
    """Status of a synthetic version; the thirteenth-copy rule wins over the fifth."""
    return (
        F.when(index % 13 == 0, "production")
        .when(index % 5 == 0, "stage")
        .otherwise(status)
    )


def wall_clock(ts: Column) -> Column:
    """Timestamp without its zone, as the session zone's wall clock shows it."""
    return ts.cast("timestamp_ntz")


def bare_table_name(name: Column) -> Column:
    """Table name without the legacy schema prefix."""
    return F.when(
        name.startswith(LEGACY_PREFIX), F.substr(name, F.lit(len(LEGACY_PREFIX) + 1))
    ).otherwise(name)


def table_name(thing: Column, action: Column, vendor: Column) -> Column:
    """Legacy table name ``action_thing_vendor``; null parts are left out."""
    return F.concat_ws("_", action, thing, vendor)


def is_name_column(table: Column, column: Column) -> Column:
    """True for the name column of a thing's table."""
    return (column == table) | (column == F.concat(table, F.lit("_name")))


def is_id_column(table: Column, column: Column) -> Column:
    """True for the id column of a thing's table."""
    return column == F.concat(table, F.lit("_id"))


def is_log_column(column: Column) -> Column:
    """True for one of the four log columns."""
    return column.isin(*LOG_COLUMNS)


def is_standard_column(table: Column, column: Column) -> Column:
    """True for a name, id or log column."""
    return (
        is_name_column(table, column)
        | is_id_column(table, column)
        | is_log_column(column)
    )


def legacy_type(spark_type: Column) -> Column:
    """Spark type name as the legacy type name that the type rules test."""
    lowered = F.lower(spark_type)
    return (
        F.when(lowered == "string", "TEXT")
        .when(lowered == "int", "INTEGER")
        .when(lowered.isin("timestamp", "timestamp_ntz"), "TIMESTAMP")
        .otherwise(F.upper(spark_type))
    )
