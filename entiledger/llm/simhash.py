"""SimHash near-duplicates by anchor-point covering.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit of
their lower or of their upper half. The anchors of a half are the words of the perfect
code of length 31 (2^26 of them, no 31-bit word is farther than one bit from one)
times the remaining bit. A fingerprint's home is the one anchor within the covering
radius 1; it is replicated to all anchors within radius plus threshold, 1 + 1: two or
17 in each half. A pair that agrees but for one bit of a half meets at the home of
either, and is compared there in all 64 bits.

Where many fingerprints share a home, the other half decides who meets: it differs in at
most three bits, so one of its two quarters in at most one. There a fingerprint goes to
its own two quarters, and is replicated to the 34 quarters within one bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from entiledger.llm.common import cut, spare, text_key
from entiledger.llm.components import components
from entiledger.operators.joins import lookup_join

#: Shingles whose bits are counted at once, so that a long text needs no more memory.
BLOCK = 1 << 16
#: Fingerprints at one home from which on they are first merged by midpoints.
DENSE = 32
#: Fingerprints at one home from which on they are compared by quarters of the other half.
SPLIT = 256

CODE_BITS = 31


def _fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    last = max(len(words) - shingle, 0) + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, last, BLOCK):
        hashes = [
            xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42)
            for i in range(start, min(start + BLOCK, last))
        ]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > last, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", into: str = "fingerprint", shingle: int = 3
) -> DataFrame:
    """docs with the SimHash of a text column, as a signed long.

    Words are runs without ASCII white space, A-Z in lower case; a text of fewer words
    than a shingle is one shingle. A null or wordless text has fingerprint 0. A column
    that is already called `into` is replaced.
    """

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(into, of(F.col(text)))


def _flips() -> np.ndarray:
    """For each syndrome, the masks of the two bits whose places have it as their xor."""
    out = np.zeros((CODE_BITS + 1, CODE_BITS // 2), np.int64)
    for s in range(1, CODE_BITS + 1):
        pairs = [(i, i ^ s) for i in range(1, CODE_BITS + 1) if 0 < i ^ s and i < i ^ s]
        out[s] = [1 << (i - 1) | 1 << (j - 1) for i, j in pairs]
    return out


FLIPS = _flips()
MASKS = [
    sum(1 << (i - 1) for i in range(1, CODE_BITS + 1) if i >> j & 1) for j in range(5)
]


def anchors(half: np.ndarray, ball: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of the home of each 32-bit value, or of all anchors near it."""
    word, extra = half & 0x7FFFFFFF, half & 0x80000000
    syndrome = np.zeros(len(half), np.int64)
    for j, mask in enumerate(MASKS):
        syndrome |= (np.bitwise_count(word & mask).astype(np.int64) & 1) << j
    flip = np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    home = (word ^ flip) | extra
    rows = np.arange(len(half))
    if not ball:
        return rows, home
    off = np.flatnonzero(syndrome)
    far = half[off, None] ^ FLIPS[syndrome[off]]
    return (
        np.concatenate([rows, rows, np.repeat(off, far.shape[1])]),
        np.concatenate([home, home ^ 0x80000000, far.ravel()]),
    )


def _dealt(fps: DataFrame, ball: bool) -> DataFrame:
    """(anchor, fp, label): a row for each fingerprint and anchor."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            label = batch.column(1).to_numpy()
            for which in (0, 1):
                half = fp >> 32 * which & 0xFFFFFFFF
                for a in range(0, len(fp), 4096):
                    row, anchor = anchors(half[a : a + 4096], ball)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor | which << 32),
                            pa.array(fp[a + row]),
                            pa.array(label[a + row]),
                        ],
                        ["anchor", "fp", "label"],
                    )

    return fps.select("fp", "label").mapInArrow(
        deal, "anchor long, fp long, label long"
    )


def _merged(fps: DataFrame) -> DataFrame:
    """Edges that join most of the fingerprints in dense places, a few for each.

    Two fingerprints within one bit of the same 64-bit word differ in at most two. So
    every fingerprint of a crowded home is put at itself and its 64 neighbours, and all
    at one word, at most 65, hang under the smallest. This finds every link of up to two
    bits there without comparing pairs. It spares links only: those that it leaves are
    found at the anchors.
    """
    home = _dealt(fps, ball=False)
    crowded = home.groupBy("anchor").count().where(F.col("count") >= DENSE)
    dense = home.join(crowded, "anchor", "left_semi").select("fp").distinct()
    near = [F.col("fp")]
    near += [F.col("fp").bitwiseXOR(F.lit(1 << i)) for i in range(63)]
    near.append(F.col("fp").bitwiseXOR(F.lit(-(1 << 63))))
    points = dense.select("fp", F.explode(F.array(*near)).alias("point"))
    low = points.groupBy("point").agg(F.min("fp").alias("low"))
    return (
        points.join(low, "point")
        .where(F.col("fp") != F.col("low"))
        .select("fp", "low")
        .distinct()
    )


def _quarters(fp: str, ball: bool) -> Column:
    """Keys of the two quarters of the half that an anchor leaves, or all within a bit.

    A key is the quarter's value, with 2**16 added for the upper one.
    """
    other = F.when(F.shiftright("anchor", 32) == 0, F.shiftrightunsigned(fp, 32))
    half = other.otherwise(F.col(fp)).bitwiseAND(0xFFFFFFFF)
    keys = []
    for upper in (0, 1):
        own = F.shiftright(half, 16 * upper).bitwiseAND(0xFFFF)
        flips = [0, *(1 << bit for bit in range(16))] if ball else [0]
        keys += [own.bitwiseXOR(F.lit(flip)) + (upper << 16) for flip in flips]
    return F.array(*keys)


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (fp, other) of different fingerprints, smaller first, of different labels.

    fps: distinct fp with a label each. Pairs of one label are left out, as they are
    known to belong together; with label = fp, all links within max_bits come back.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("halves that differ in one bit cover up to three bits")
    home = cut(_dealt(fps, ball=False))
    crowded = cut(home.groupBy("anchor").count().where(F.col("count") >= SPLIT))
    places = crowded.select("anchor", F.lit(True).alias("crowded"))

    def placed(rows: DataFrame, fp: str, ball: bool) -> DataFrame:
        told = rows.join(places, "anchor", "left")
        keys = F.when(F.col("crowded"), _quarters(fp, ball))
        keys = F.coalesce(keys, F.array(F.lit(-1).cast("long")))
        return told.withColumn("quarter", F.explode(keys)).drop("crowded")

    ball = _dealt(fps, ball=True).toDF("anchor", "other", "other_label")
    met = placed(home, "fp", False).join(placed(ball, "other", True), ["anchor", "quarter"])
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    return (
        met.where(F.col("fp") < F.col("other"))
        .where((F.col("label") != F.col("other_label")) & (apart <= max_bits))
        .select("fp", "other")
        .distinct()
    )


def groups(marked: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, component_fp, component_id) of every distinct fingerprint.

    marked: rows (doc_id, fp). component_fp is the smallest fingerprint of the component
    and component_id the smallest doc_id, null where all are null. Rows of one
    fingerprint are merged before anything is compared, so copies cost nothing.
    """
    reps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    alone = reps.select("fp", F.col("fp").alias("label"))
    if max_bits >= 2:
        near = cut(_merged(alone))
        known = components(near).withColumnRenamed("node", "fp")
        labelled = reps.select("fp").join(known, "fp", "left")
        labelled = cut(labelled.select("fp", F.coalesce("label", "fp").alias("label")))
    else:
        near, labelled = alone.limit(0), alone
    found = links(labelled, max_bits).toDF("fp", "low").union(near)
    joined = components(found).withColumnRenamed("node", "fp")
    table = reps.join(joined, "fp", "left").select(
        "fp", "rep", F.coalesce("label", "fp").alias("component_fp")
    )
    # Read twice below, and the components behind it are many joins.
    table = cut(table)
    smallest = table.groupBy("component_fp").agg(F.min("rep").alias("component_id"))
    return table.join(smallest, "component_fp").select(
        "fp", "component_fp", "component_id"
    )


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, key, fp, component_fp, component_id) of every row of docs."""
    light = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    marked = fingerprints(light, into="fp", shingle=shingle)
    marked = cut(marked.select("doc_id", "key", "fp"))
    # A fingerprint that many copies share, such as that of empty texts, is spread.
    return lookup_join(marked, groups(marked, max_bits), "fp", "inner", ["doc_id", "key"])


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_fp, component_id), a row for each row of docs.

    docs: doc_id (integer) and text; other columns are ignored, whatever their names.
    Documents link at max_bits or fewer differing bits. A null or empty text has
    fingerprint 0 and is linked like any other; a null doc_id is never a component_id
    unless all of the component are null. Repeated rows are kept. An empty table gives
    no rows.
    """
    grouped = _grouped(docs, shingle, max_bits)
    return grouped.select("doc_id", "fp", "component_fp", "component_id")


def survivors(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id.

    Of several texts or rows with that doc_id, one stays, the same one on every run. All
    columns of docs stay as they are, of any name and type.
    """
    first = _grouped(docs, shingle, max_bits).where(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    one, low, number, own, row = (
        spare(docs, name) for name in ("_id", "_low", "_number", "_own", "_row")
    )
    kept = cut(
        first.groupBy("component_fp", F.col("doc_id").alias("id"), "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("component_fp", "id")
        .agg(F.min(F.struct("key", "n")).alias("least"))
        .select(
            F.col("id").alias(one),
            F.col("least.key").alias(low),
            F.col("least.n").alias(number),
        )
    )
    keyed = docs.withColumn(own, text_key(F.col("text")))
    same = keyed["doc_id"].eqNullSafe(kept[one]) & (keyed[own] == kept[low])
    chosen = keyed.join(kept, same)
    # Only rows that repeat both doc_id and text are grouped, which moves their texts.
    names = docs.columns
    single = chosen.where(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in names])
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    repeated = (
        chosen.where(F.col(number) > 1)
        .groupBy(one, own)
        .agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias(row))
    )
    picked = [F.col(row).getField(c).alias(c) for c in names]
    return single.union(repeated.select(*picked))
