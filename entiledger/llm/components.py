"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiledger.llm.common import cut


def _mark(pairs: DataFrame) -> tuple:
    """A digest of a set of pairs."""
    return tuple(
        pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge to another one.

    edges: two columns of longs, of any name; loops and repeated edges do no harm and
    nulls link nothing. The label is the smallest node of the component. Every round
    hangs all larger neighbours of a node under its smallest one, then all smaller ones;
    rounds end when no edge changes, after about the logarithm of the longest path.
    Minima are taken map-side first, and the joins that follow are plain ones whose
    large keys adaptive execution splits, so a hub's edges needn't fit in a task. Each
    round is checkpointed.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    pairs = cut(
        edges.where(a != b)
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where(F.col("v") != F.col("m")).select("v", "m")
        pairs = cut(hung.union(low.select("u", "m")).toDF("u", "v").distinct())
        before, mark = mark, _mark(pairs)
        if before == mark:
            break
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.union(pairs.select("v", "v").distinct())
