"""Declared schemas: wide sheets to columns and vendors, and back to a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiledger.model import ColumnSpec, TableSpec

_COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("foreign_table", T.StringType()),
    ]
)
TABLE_TYPE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("columns", T.ArrayType(_COLUMN)),
        T.StructField("vendors", T.ArrayType(T.StringType())),
    ]
)
DOCUMENT_TYPE = T.StructType([T.StructField("tables", T.ArrayType(TABLE_TYPE))])


def _blank(cell: Column) -> Column:
    return cell.isNull() | (cell == "")


def sheet_columns(sheet: DataFrame) -> DataFrame:
    """Column lists of a wide sheet: table, name, type, name, type, ...

    A row ends at its first pair with a blank; an odd last cell is left out.
    """
    first, *cells = sheet.columns
    pairs = F.array(
        *[
            F.struct(
                F.col(name).cast("string").alias("name"),
                F.col(kind).cast("string").alias("data_type"),
                F.lit(None).cast("string").alias("foreign_table"),
            )
            for name, kind in zip(cells[::2], cells[1::2])
        ]
    ).cast(T.ArrayType(_COLUMN))
    blanks = F.transform(
        pairs, lambda p: _blank(p.getField("name")) | _blank(p.getField("data_type"))
    )
    end = F.array_position(blanks, F.lit(True))
    length = F.when(end == 0, F.size(pairs)).otherwise((end - 1).cast("int"))
    return sheet.select(
        F.col(first).cast("string").alias("name"),
        F.slice(pairs, F.lit(1), length).alias("columns"),
    )


def sheet_vendors(sheet: DataFrame, row_no: str | None = None) -> DataFrame:
    """Vendor lists of a wide sheet: table, vendor, vendor, ...; blanks are skipped.

    With ``row_no`` the last of several rows of a table wins.
    """
    first, *cells = [c for c in sheet.columns if c != row_no]
    filled = F.filter(
        F.array(*[F.col(c).cast("string") for c in cells]), lambda c: ~_blank(c)
    )
    listed = sheet.select(
        F.col(first).cast("string").alias("name"),
        filled.alias("vendors"),
        *([F.col(row_no)] if row_no else []),
    )
    if row_no is None:
        return listed
    return listed.groupBy("name").agg(F.max_by("vendors", row_no).alias("vendors"))


def build_tables(columns: DataFrame, vendors: DataFrame) -> DataFrame:
    """Declared tables from both sheets; a table without vendors has an empty list."""
    none = F.array().cast("array<string>")
    return columns.join(vendors, "name", "left").select(
        "name", "columns", F.coalesce("vendors", none).alias("vendors")
    )


def declared_columns(tables: DataFrame) -> DataFrame:
    """One row per declared column; a table without columns keeps one null row."""
    return tables.select(
        F.col("name").alias("table_name"), F.explode_outer("columns").alias("c")
    ).select(
        "table_name", F.col("c.name").alias("column_name"), "c.data_type", "c.foreign_table"
    )


def declared_vendors(tables: DataFrame) -> DataFrame:
    """One row per table and vendor."""
    return tables.select(
        F.col("name").alias("table_name"), F.explode("vendors").alias("vendor")
    )


def to_json_rows(tables: DataFrame) -> DataFrame:
    """Each declared table as one JSON object, nulls written out."""
    text = F.to_json(F.struct("name", "columns", "vendors"), {"ignoreNullFields": "false"})
    return tables.select("name", text.alias("json"))


def from_json_rows(rows: DataFrame) -> DataFrame:
    """Declared tables from one JSON object per row."""
    return rows.select(F.from_json("json", TABLE_TYPE).alias("t")).select("t.*")


def table_specs(tables: DataFrame) -> list[TableSpec]:
    """Declared tables as specs. A schema document is small by nature: it names
    tables and columns, never data."""
    return [
        TableSpec(
            row["name"],
            tuple(
                ColumnSpec(c["name"], c["data_type"], c["foreign_table"])
                for c in row["columns"] or []
            ),
            tuple(row["vendors"] or []),
        )
        for row in tables.select("name", "columns", "vendors").toLocalIterator()
    ]
