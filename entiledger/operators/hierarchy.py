"""Category trees from level columns: nodes, duplicates, preorder, markup.

A node is a distinct path from the root. Siblings keep the order in which the
input first names them, so a node is placed by the input row that names it first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.operators.joins import lookup_join

OUTLINE_LEVELS = 6

# Markup of the tree page.
PAGE_HEAD = """<!DOCTYPE html>
    <html lang = "en">
    <head>
        <meta charset = "UTF-8">
        <title > Title </title>
        <link href = "https://unpkg.com/treeflex/dist/css/treeflex.css" rel = "stylesheet">
    </head>
    <body>
        <div class="tf-tree example">
        <ul>"""
PAGE_FOOT = """        </ul>
    </div>
    </body>
</html>"""
ITEM_OPEN = '<li>\n<span class="tf-nc">'
ITEM_NAMED = "</span>\n"
LIST_OPEN = "<ul>\n"
ITEM_CLOSE = "</li>"
LIST_CLOSE = "</ul>\n</li>"
BASE_NAME = "base"


def category_names(categories: DataFrame, row_no: str) -> DataFrame:
    """Name per category id; the last row wins."""
    return categories.groupBy("category_id").agg(
        F.max_by("category_name", row_no).alias("category_name")
    )


def category_ids(categories: DataFrame, row_no: str) -> DataFrame:
    """Id per category name; the last row wins."""
    return categories.groupBy("category_name").agg(
        F.max_by("category_id", row_no).alias("category_id")
    )


def decode_levels(
    rows: DataFrame,
    levels: list[str],
    names: DataFrame,
) -> DataFrame:
    """Replace category ids in the level columns by their names."""
    original = rows
    for level in levels:
        lookup = names.select(
            F.col("category_id").alias(level), F.col("category_name").alias("_name")
        )
        rows = lookup_join(
            rows, lookup, level, "left", profile=original
        ).select(
            *[F.col("_name").alias(c) if c == level else F.col(c) for c in rows.columns]
        )
    return rows


def level_paths(rows: DataFrame, columns: list[str], row_no: str) -> DataFrame:
    """Path of each row: the level values without the first column's.

    A value that a row names twice is kept once, at its first place. A level without a
    value is left out, and a row without any names no node.
    """
    values = F.array_compact(F.array(*[F.col(c).cast("string") for c in columns[1:]]))
    return rows.select(
        F.array_distinct(values).alias("path"), F.col(row_no).alias("row_no")
    )


def _prefixes(path: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(path)), lambda n: F.slice(path, 1, n)
    )


def tree_nodes(paths: DataFrame) -> DataFrame:
    """Distinct nodes with name, level from 0, parent path and first row.

    Equal paths are merged before they are unfolded into prefixes.
    """
    named = paths.where(F.size("path") > 0)
    merged = named.groupBy("path").agg(F.min("row_no").alias("first_row"))
    unfolded = merged.select(
        F.explode(_prefixes(F.col("path"))).alias("path"), "first_row"
    )
    nodes = unfolded.groupBy("path").agg(F.min("first_row").alias("first_row"))
    path = F.col("path")
    return nodes.select(
        "path",
        F.element_at(path, -1).alias("name"),
        (F.size(path) - 1).alias("level"),
        F.slice(path, F.lit(1), F.size(path) - 1).alias("parent"),
        "first_row",
    )


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """Names that stand at more than one place of the tree."""
    places = nodes.groupBy("name").agg(F.count(F.lit(1)).alias("places"))
    return places.where(F.col("places") > 1)


def preorder(nodes: DataFrame) -> DataFrame:
    """Nodes with the key that sorts them in preorder.

    ``sort_key`` holds the first row of every ancestor and of the node itself.
    ``has_children`` and ``closes``, the number of lists that end after the node,
    serve the markup. Every node looks up its own row and those of its ancestors; a
    row tells where the node starts and where its last child does, so the last child
    and the nodes with children need no joins of their own. Ancestors that most nodes
    share are hot keys of that lookup.
    """
    none = F.lit(None).cast("long")
    known = nodes.select("path", "first_row", none.alias("last_child")).union(
        nodes.select("parent", none, "first_row")
    )
    starts = known.groupBy(F.col("path").alias("ancestor")).agg(
        F.max("first_row").alias("row"), F.max("last_child").alias("last_child")
    )
    path = F.col("path")
    chains = nodes.select(
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size(path)), lambda n: F.slice(path, 1, n)
            )
        ).alias("ancestor"),
    )
    step = F.struct(F.size("ancestor").alias("depth"), "row", "last_child")
    chained = (
        lookup_join(chains, starts, "ancestor", "inner", ["path"])
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(step)).alias("chain"))
    )
    chain = F.col("chain")
    # The chain starts with the root, which is no node.
    own = F.slice(chain, F.lit(2), F.size(path))
    open_steps = F.filter(
        own,
        lambda s, i: s.getField("row") != F.get(chain, i).getField("last_child"),
    )
    deepest_open = F.coalesce(
        F.try_element_at(open_steps, F.lit(-1)).getField("depth"), F.lit(0)
    )
    inner = F.element_at(chain, -1).getField("last_child").isNotNull()
    return chained.select(
        "path",
        F.element_at(path, -1).alias("name"),
        (F.size(path) - 1).alias("level"),
        F.transform(own, lambda s: s.getField("row")).alias("sort_key"),
        inner.alias("has_children"),
        F.when(inner, 0).otherwise(F.size(path) - deepest_open).alias("closes"),
    )


def indented(ordered: DataFrame) -> DataFrame:
    """Text outline lines: three blanks per level, a blank and the name."""
    return ordered.select(
        "path",
        "sort_key",
        F.concat(
            F.repeat(F.lit("   "), F.col("level")), F.lit(" "), F.col("name")
        ).alias("line"),
    )


def outline(ordered: DataFrame, levels: int = OUTLINE_LEVELS) -> DataFrame:
    """Outline columns ``cat_0``.. with the name in its level's column.

    A node deeper than the outline is an error.
    """
    too_deep = F.raise_error(
        F.concat(F.lit("node deeper than the outline: "), F.col("name"))
    ).cast("string")
    cells = [
        F.when(F.col("level") >= levels, too_deep)
        .when(F.col("level") == k, F.col("name"))
        .otherwise("")
        .alias(f"cat_{k}")
        for k in range(levels)
    ]
    return ordered.select("sort_key", *cells)


def markup(ordered: DataFrame) -> DataFrame:
    """Nested-list markup of each node; joined in preorder it is the whole tree.

    The list of the base node stays open and is closed by the last node.
    """
    opened = F.concat(F.lit(ITEM_OPEN), F.col("name"), F.lit(ITEM_NAMED))
    closed = F.concat(
        F.lit(ITEM_CLOSE), F.repeat(F.lit(LIST_CLOSE), F.col("closes"))
    )
    tail = F.when(F.col("has_children"), F.lit(LIST_OPEN)).otherwise(closed)
    return ordered.select("path", "sort_key", F.concat(opened, tail).alias("html"))


def html_page(ordered: DataFrame) -> DataFrame:
    """Lines of the whole page in order, ready for a text sink."""
    spark = ordered.sparkSession
    nodes = markup(ordered)
    base = f"{ITEM_OPEN}{BASE_NAME}{ITEM_NAMED}"
    ends = F.map_from_arrays(
        F.array(F.lit(-1), F.lit(1)),
        F.array(F.lit(f"{PAGE_HEAD}\n{base}{LIST_OPEN}"), F.lit(PAGE_FOOT)),
    )
    frame = spark.range(0, 1, 1, 1).select(F.explode(ends).alias("part", "value"))
    body = nodes.select(F.lit(0).alias("part"), "sort_key", F.col("html").alias("value"))
    key = F.array().cast(nodes.schema["sort_key"].dataType)
    whole = body.unionByName(frame.select("part", key.alias("sort_key"), "value"))
    return whole.orderBy("part", "sort_key").select("value")
