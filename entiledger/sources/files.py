"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiledger.operators.hierarchy import html_page, outline
from entiledger.operators.schema import DOCUMENT_TYPE, TABLE_TYPE

FORMATS = ("csv", "json", "parquet", "orc")


def _file_order(fmt: str) -> Column:
    """Number that orders the rows of one file as they stand in it.

    Parquet keeps row numbers. A line of text takes the byte offset of its split
    plus its place there, which is less than the length of the split.
    """
    if fmt == "parquet":
        return F.col("_metadata.row_index")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start") + place


def _plain(path: str) -> str:
    """A file's path without scheme and escapes."""
    return unquote(urlsplit(path).path)


def _batch_of(path: str, sources: Sequence[str]) -> int:
    """Number from 1 of the file or folder that a file belongs to."""
    for place, source in enumerate(sources, start=1):
        if path == source or path.startswith(source.rstrip("/") + "/"):
            return place
    raise ValueError(f"{path}: of none of the given paths")


def _numbered(
    rows: DataFrame, fmt: str, row_no: str, sources: Sequence[str] = ()
) -> DataFrame:
    """Rows numbered by file, then by place in the file.

    Files follow each other by path; a file has less than 2**44 rows or bytes. With
    ``sources`` the rows also get the number of their source as ``batch_no``.
    """
    paths = sorted({_plain(p) for p in rows.inputFiles()})
    if len(paths) < 2 and not sources:
        return rows.withColumn(row_no, _file_order(fmt))
    spark = rows.sparkSession
    plain = [_plain(p) for p in sources]
    # One row per file of the load.
    places = spark.createDataFrame(
        [
            (path, place << 44, _batch_of(path, plain) if plain else 0)
            for place, path in enumerate(paths)
        ],
        "_path string, _before long, batch_no int",
    )
    path = F.url_decode(
        F.replace(F.parse_url(F.col("_metadata.file_path"), F.lit("PATH")), F.lit("+"), F.lit("%2B"))
    )
    placed = rows.withColumn("_path", path).withColumn(row_no, _file_order(fmt))
    joined = placed.join(F.broadcast(places), "_path", "left")
    unknown = F.raise_error(F.concat(F.lit("file without a place: "), "_path"))
    before = F.coalesce("_before", unknown.cast("long"))
    kept = [*rows.columns, *(["batch_no"] if sources else [])]
    return joined.select(*kept, (before + F.col(row_no)).alias(row_no))


def _by_header(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV rows whose columns are found by the names in the header.

    All files of a folder have the header of the first one; another one fails.
    """
    first = path if isinstance(path, str) else path[0]
    header = spark.read.option("header", True).csv(first).columns
    missing = [f.name for f in schema if f.name not in header]
    unknown = [c for c in header if c not in schema.names]
    if missing or unknown:
        raise ValueError(
            f"{first}: missing columns {missing}, unknown columns {unknown}"
        )
    ordered = T.StructType([schema[c] for c in header])
    return (
        spark.read.schema(ordered)
        .option("mode", "FAILFAST")
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_load_file(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "csv",
    row_no: str | None = None,
) -> DataFrame:
    """Load file or folder of files with the given schema; one per workbook sheet.

    Columns are found by name, in a CSV file by its header, whatever their order. A CSV
    or JSON file that does not fit the schema fails instead of turning values into
    nulls, and so does a header with other columns. With ``row_no`` that column numbers
    the rows in the order of files by path and of rows in a file, with gaps.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown file format {fmt!r}")
    if row_no is not None and fmt == "orc":
        raise ValueError("an ORC file does not tell the order of its rows")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "csv":
        rows = _by_header(spark, path, schema)
    else:
        reader = spark.read.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "FAILFAST")
        rows = reader.format(fmt).load(path)
    if row_no is None:
        return rows.select(*schema.names)
    return _numbered(rows, fmt, row_no).select(*schema.names, row_no)


def read_load_series(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str,
    fmt: str,
    row_no: str,
) -> DataFrame:
    """Load files or folders as one table, told apart by ``batch_no`` from 1.

    As :func:`read_load_file` for each path, but one scan reads all of them, and the path
    of a row's file gives its batch. CSV files must share one header.
    """
    if fmt == "orc":
        raise ValueError("an ORC file does not tell the order of its rows")
    if fmt not in FORMATS:
        raise ValueError(f"unknown file format {fmt!r}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "csv":
        rows = _by_header(spark, list(paths), schema)
    else:
        reader = spark.read.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "FAILFAST")
        rows = reader.format(fmt).load(list(paths))
    placed = _numbered(rows, fmt, row_no, paths)
    return placed.select(*schema.names, row_no, "batch_no")


def read_table_names(spark: SparkSession, path: str) -> DataFrame:
    """List of table names, one per line; blank lines are dropped."""
    lines = spark.read.text(path).select(
        F.regexp_replace(F.trim("value"), "[\r\n]", "").alias("table_name")
    )
    return lines.where(F.col("table_name") != "")


def read_schema_document(spark: SparkSession, path: str) -> DataFrame:
    """Declared tables of a schema document, ``{"tables": [...]}``."""
    document = spark.read.schema(DOCUMENT_TYPE).option("multiLine", True).json(path)
    return document.select(F.explode("tables").alias("t")).select("t.*")


def write_schema_document(
    tables: DataFrame, path: str, order: str | None = None, mode: str = "error"
) -> None:
    """Write declared tables as one schema document.

    The document is one row by its format. It describes tables, so it stays small.
    """
    place = F.col(order) if order else F.monotonically_increasing_id()
    entry = F.struct(
        place.alias("place"), F.struct("name", "columns", "vendors").alias("t")
    )
    listed = tables.select(entry.alias("e")).agg(
        F.sort_array(F.collect_list("e")).alias("es")
    )
    document = listed.select(
        F.transform("es", lambda e: e.getField("t"))
        .cast(T.ArrayType(TABLE_TYPE))
        .alias("tables")
    )
    document.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write a query result or a report."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown file format {fmt!r}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_outline(ordered: DataFrame, path: str, mode: str = "error") -> None:
    """Write the outline of a tree as CSV, in preorder over the part files."""
    rows = outline(ordered).orderBy("sort_key").drop("sort_key")
    write_rows(rows, path, "csv", mode)


def write_html(ordered: DataFrame, path: str, mode: str = "error") -> None:
    """Write the nested-list page of a tree; part files follow each other."""
    html_page(ordered).write.mode(mode).text(path)
