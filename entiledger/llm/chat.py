"""Collapse of logged conversation snapshots, and chat rendering; built-in functions only.

A log that appends to a conversation and stores it again holds every earlier state as a
conversation of its own. The rolling hash of a turn is the exclusive or of the hashes of
all turns up to it, each hashed with its position; two conversations have the same hash
after n turns if their first n turns are the same. A conversation whose last hash is
found at an inner turn of a longer one is dropped by an anti-join; of equal ones that of
the smallest id stays.

Turn numbers may repeat or be missing, so equal turns are counted first, and their counts
are summed by ranges of turn and digest; that gives every turn its position. Long
conversations are cut into blocks of positions. Windows run within blocks, and what
earlier blocks add comes from one row for each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiledger.llm.common import cut
from entiledger.operators.joins import lookup_join

#: Turns of a block and of a rendered part.
BLOCK = 512

#: The marks around a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _digest(role: Column, text: Column) -> Column:
    """Digest of what a turn says; a null differs from an empty string."""
    size = F.length(role).cast("string")
    return F.sha2(
        F.concat(
            F.coalesce(F.concat(size, F.lit(":"), role), F.lit("-")),
            F.coalesce(F.concat(F.lit("t"), text), F.lit("-")),
        ),
        256,
    )


#: What tells a turn from others of its conversation; `known` is false without a number.
KEY = ["conv_id", "range", "known", "at", "digest"]


def _turns(turns: DataFrame, block: int, *more: Column) -> DataFrame:
    """KEY, and more columns, of turns that have a conv_id; range is one of turn numbers."""
    return turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / block), F.lit(-1)).alias("range"),
        F.col("turn").isNotNull().alias("known"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("at"),
        _digest(F.col("role"), F.col("text")).alias("digest"),
        *more,
    )


def _before(sums: DataFrame, value: Column, name: str, order: str = "block") -> DataFrame:
    """What the earlier blocks of a conversation add up to."""
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sums.withColumn(name, F.coalesce(value.over(earlier), F.lit(0)))


def positions(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """KEY with (n, ahead, size) of each different turn, written to the checkpoints.

    n is how often the turn is there, ahead how many turns come before it in order of
    number, nulls first, then digest, and size the number of turns of the conversation.
    Turns of one number are spread by the first three digits of their digest.
    """
    said = _turns(turns, block).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    said = said.withColumn("near", F.substring("digest", 1, 3))
    order = ["known", "at", "near"]
    key = ["conv_id", "range", *order]
    none, first = F.lit(0).cast("long"), Window.unboundedPreceding
    ranges = said.groupBy(*key).agg(F.sum("n").alias("n"))
    sums = ranges.groupBy("conv_id", "range").agg(F.sum("n").alias("n"))
    starts = _before(sums, F.sum("n"), "start", "range").withColumn(
        "size", F.sum("n").over(Window.partitionBy("conv_id"))
    )
    inside = Window.partitionBy("conv_id", "range").orderBy(*order).rowsBetween(first, -1)
    spot = Window.partitionBy(*key).orderBy("digest").rowsBetween(first, -1)
    offsets = (
        ranges.withColumn("inside", F.coalesce(F.sum("n").over(inside), none))
        .join(starts.drop("n"), ["conv_id", "range"])
        .select(*key, (F.col("start") + F.col("inside")).alias("offset"), "size")
    )
    placed = (
        said.withColumn("place", F.coalesce(F.sum("n").over(spot), none))
        .join(offsets, key)
        .select(*KEY, "n", (F.col("offset") + F.col("place")).alias("ahead"), "size")
    )
    # Read for the hashes and again for the rendering; it holds no texts.
    return cut(placed)


def _chunks(placed: DataFrame, block: int) -> DataFrame:
    """Rows of `positions` for each run of positions: with (chunk, low, high).

    A chunk has `block` positions of a conversation; they count from 1.
    """
    last = F.col("ahead") + F.col("n") - 1
    spots = F.sequence(F.floor(F.col("ahead") / block), F.floor(last / block))
    return placed.withColumn("chunk", F.explode(spots)).withColumns(
        {
            "low": F.greatest(F.col("ahead"), F.col("chunk") * block) + 1,
            "high": F.least(last, F.col("chunk") * block + block - 1) + 1,
        }
    )


def prefixes(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, pos, size, h1, h2): the rolling hash after each turn.

    placed: what `positions` gives. pos counts the turns of a conversation from 1.
    """
    key = ["conv_id", "block"]
    chunks = _chunks(placed, block).select(
        "conv_id", F.col("chunk").alias("block"), "low", "high", "size", "digest"
    )
    # Runs are dealt out before they are unfolded, as a turn may be repeated very often.
    placed = chunks.repartition(*key).select(
        *key, F.explode(F.sequence("low", "high")).alias("pos"), "size", "digest"
    )
    so_far = (
        Window.partitionBy(*key)
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        placed.withColumn("a", F.xxhash64(F.lit(1), "pos", "digest")).withColumn("b", F.xxhash64(F.lit(2), "pos", "digest"))
    )
    inner = placed.select(
        *key,
        "pos",
        "size",
        F.bit_xor("a").over(so_far).alias("a"),
        F.bit_xor("b").over(so_far).alias("b"),
    )
    sums = placed.groupBy(*key).agg(
        F.bit_xor("a").alias("sum_a"), F.bit_xor("b").alias("sum_b")
    )
    sums = _before(sums, F.bit_xor("sum_a"), "from_a")
    sums = _before(sums, F.bit_xor("sum_b"), "from_b")
    return inner.join(sums.select(*key, "from_a", "from_b"), key).select(
        *key,
        "pos",
        "size",
        F.col("a").bitwiseXOR(F.col("from_a")).alias("h1"),
        F.col("b").bitwiseXOR(F.col("from_b")).alias("h2"),
    )


def maximal(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id of the conversations that no longer one begins with, one of equal ones.

    Both sides of the anti-join have a row for each different hash, so neither a common
    first turn nor a conversation that is logged many times makes a hot key.
    """
    rolling = prefixes(placed, block)
    hashes = ["pos", "h1", "h2"]
    last = (
        rolling.where(F.col("pos") == F.col("size"))
        .groupBy(*hashes)
        .agg(F.min("conv_id").alias("conv_id"))
    )
    inner = rolling.where(F.col("pos") < F.col("size")).select(*hashes).distinct()
    return last.join(inner, hashes, "left_anti").select("conv_id")


def render(
    turns: DataFrame, block: int = BLOCK, placed: DataFrame | None = None
) -> DataFrame:
    """(conv_id, part, n_turns, text): each conversation in chat marks, in parts.

    A part holds `block` turns by position, the last one what is left, so a row stays
    bounded; parts count from 0 and follow one another. Null roles and texts render as
    empty, and marks within a text are broken up. placed: what `positions` gives for the
    turns, or for the conversations that are wanted.
    """
    placed = positions(turns, block) if placed is None else placed
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    piece = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), plain, F.lit(CLOSE)
    )
    pieces = _turns(turns, block, piece.alias("piece")).groupBy(*KEY)
    # The grouping and the join share one shuffle of the texts.
    same = pieces.agg(F.any_value("piece").alias("piece")).join(placed, KEY)
    times = (F.col("high") - F.col("low") + 1).cast("int")
    said = _chunks(same, block).select(
        "conv_id",
        F.col("chunk").alias("part"),
        F.struct("low", times.alias("times"), "piece").alias("said"),
    )
    listed = said.groupBy("conv_id", "part").agg(
        F.sum("said.times").alias("n_turns"), F.array_sort(F.collect_list("said")).alias("said")
    )
    text = F.flatten(
        F.transform("said", lambda s: F.array_repeat(s["piece"], s["times"]))
    )
    return listed.select("conv_id", "part", "n_turns", F.array_join(text, "\n").alias("text"))


def collapsed(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The maximal conversations, rendered as by `render`.

    turns: conv_id, turn, role and text; other columns are ignored. Turns of one number
    are ordered by a digest of role and text, those without a number come first, repeated
    rows are turns of their own, and rows without a conv_id belong to no conversation. An
    empty table gives no rows. The turns of a conversation with very many are spread.
    """
    placed = positions(turns, block)
    ids = cut(maximal(placed, block))
    kept = lookup_join(placed, ids, "conv_id", "inner", ["at", "digest"])
    return render(turns, block, kept)
