"""Column catalogs: one row per column of each table."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_TYPE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
    ]
)

_ARROW_TYPE = pa.schema(
    [
        ("table_name", pa.string()),
        ("ordinal", pa.int32()),
        ("column_name", pa.string()),
        ("data_type", pa.string()),
    ]
)

# Metadata key under which Spark keeps the declared type of a text column.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def _type_name(column: T.StructField) -> str:
    return column.metadata.get(_DECLARED, column.dataType.simpleString())


def catalog_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalog of the given tables; reads their schemas only."""
    rows = [
        {
            "table_name": name,
            "ordinal": place,
            "column_name": column.name,
            "data_type": _type_name(column),
        }
        for name, df in tables.items()
        for place, column in enumerate(df.schema)
    ]
    # An Arrow table of this size becomes a local relation, which needs no tasks.
    table = pa.Table.from_pylist(rows, schema=_ARROW_TYPE)
    return spark.createDataFrame(table, CATALOG_TYPE)


def reflect(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """All permanent tables of a database by name."""
    return {
        table.name: spark.table(f"`{database}`.`{table.name}`")
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Legacy table over JDBC, read in ranges of an integer column.

    The bounds only shape the ranges; rows outside them are read as well.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(partitions),
    )
    return reader.options(**(options or {})).load()
