"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three times a random change of signs and a fast Hadamard transform)
turns a unit vector, and the nearest signed axis is its bucket. Every table has rotations
of its own. A query looks into the buckets of its nearest axes in every table, and what it
finds there is ranked by exact cosine, in blocks of a bounded size. Vectors that repeat are
searched and found once; only their smallest ids are kept, as many as can be in a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiledger.llm.common import cut
from entiledger.operators.joins import lookup_join

#: Tables, hashes of a table's bucket, and axes of each hash that a query looks at.
#: With one hash of 64 dimensions these look at half of all candidates, which random
#: vectors need for a recall of 0.9; a hash more divides the candidates of a table by
#: five and the chance to find a neighbour by two and a half, so takes more tables.
TABLES, HASHES, AXES = 8, 1, 12
SEED = 7
#: Candidates and queries of a block.
BLOCK, QUERY_BLOCK = 4096, 2048
#: Components of pairs that are multiplied at a time.
PAIR_CELLS = 1 << 20


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows whose length is a power of two."""
    n, step = rows.shape[1], 1
    while step < n:
        pairs = rows.reshape(len(rows), n // (2 * step), 2, step)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([low + high, low - high], 2).reshape(len(rows), n)
        step *= 2
    return rows / np.sqrt(n)


def rotated(rows: np.ndarray, table: int, number: int, seed: int) -> np.ndarray:
    """Rows, filled up with zeros to a power of two, under one pseudo-rotation."""
    size = 1 << max(rows.shape[1] - 1, 0).bit_length()
    rows = np.pad(rows, ((0, 0), (0, size - rows.shape[1])))
    signs = np.random.default_rng([seed, table, number, size])
    for _ in range(3):
        rows = hadamard(rows * signs.choice([-1.0, 1.0], size))
    return rows


def buckets(
    rows: np.ndarray, table: int, hashes: int, axes: int, seed: int = SEED
) -> np.ndarray:
    """Bucket numbers of each row in a table: the axes nearest ones of every hash."""
    out = np.zeros((len(rows), 1), np.int64)
    for number in range(hashes):
        turned = rotated(rows, table, number, seed)
        width = turned.shape[1]
        near = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :axes]
        signs = np.take_along_axis(turned, near, 1) > 0
        code = 2 * near + signs
        out = (out[:, :, None] * (2 * width) + code[:, None, :]).reshape(len(rows), -1)
    return out


def _units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, norms) of vectors of one length in double precision.

    Rows are scaled by their largest component, so that no square overflows.
    """
    flat = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    scaled = flat / np.abs(flat).max(1, keepdims=True)
    return scaled, np.sqrt((scaled * scaled).sum(1))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    size = F.coalesce(F.size(vector), F.lit(-1))
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (size > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _dealt(vectors: DataFrame, axes: int, tables: int, hashes: int, seed: int):
    """(id, embedding, dim, table, bucket): a row for each bucket of each vector."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                yield from of(batch.slice(a, 1024))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            rows, norms = _units(part.column("embedding"))
            for table in range(tables):
                found = buckets(rows / norms[:, None], table, hashes, axes, seed)
                at = pa.array(np.repeat(np.arange(len(found)), found.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(at),
                        part.column("embedding").take(at),
                        part.column("dim").take(at),
                        pa.array(np.full(len(at), table, np.int32)),
                        pa.array(found.ravel()),
                    ],
                    ["id", "embedding", "dim", "table", "bucket"],
                )

    schema = "id long, embedding array<float>, dim int, table int, bucket long"
    if dict(vectors.dtypes)["embedding"] == "array<double>":
        schema = schema.replace("float", "double")
    return vectors.select("id", "embedding", "dim").mapInArrow(deal, schema)


def _cosines(
    asked: np.ndarray,
    lengths: np.ndarray,
    one: np.ndarray,
    rows: np.ndarray,
    norms: np.ndarray,
    other: np.ndarray,
) -> np.ndarray:
    """Cosines of pairs of rows, a bounded number of pairs at a time.

    Each is summed by itself: a product of matrices may round by its shape.
    """
    step = max(1, PAIR_CELLS // rows.shape[1])
    out = [
        (asked[one[a : a + step]] * rows[other[a : a + step]]).sum(1)
        for a in range(0, len(one), step)
    ]
    return np.concatenate(out) / (lengths[one] * norms[other])


def _ranker(keep: int):
    """Function of two tables, candidates and queries of a block: its best pairs."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "id", "score"]
        if not left.num_rows or not right.num_rows:
            empty = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())]
            return pa.Table.from_arrays(empty, names)
        ids = left.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        rows, norms = _units(left.column("embedding").combine_chunks())
        ids, rows, norms = ids[order], rows[order], norms[order]
        queries = right.column("id").to_numpy()
        asked, lengths = _units(right.column("embedding").combine_chunks())
        many = min(len(ids), keep)
        # Twice what a product of matrices and a row's own sum can differ by.
        margin = 8 * (rows.shape[1] + 16) * np.finfo(np.float64).eps
        out = [[], [], []]
        for a in range(0, len(queries), 256):
            block = asked[a : a + 256] / lengths[a : a + 256, None]
            near = block @ (rows / norms[:, None]).T
            least = np.partition(near, len(ids) - many, axis=1)[:, len(ids) - many]
            # All that may be among the first, however many are equal.
            one, other = np.nonzero(near >= least[:, None] - margin)
            exact = _cosines(asked, lengths, a + one, rows, norms, other)
            order = np.lexsort((other, -exact, one))
            one, other, exact = one[order], other[order], exact[order]
            place = np.arange(len(one)) - np.searchsorted(one, one)
            first = place < many
            out[0].append(queries[a + one[first]])
            out[1].append(ids[other[first]])
            out[2].append(exact[first])
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in out], names)

    return best


def _ranked(rows: DataFrame, by: list, order: list, keep: int, name: str) -> DataFrame:
    """The first rows of each group, which every task cuts its share to first."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, place).where(F.col(name) <= keep)


def _blocked(keyed: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Rows at every block of their bucket: one of their own side, all of the other."""
    key = ["dim", "table", "bucket"]
    spot = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
    return (
        keyed.join(sizes, key)
        .withColumn(own, spot)
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        .withColumn(other, F.col(other).cast("int"))
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    hashes: int = HASHES,
    axes: int = AXES,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query by cosine.

    vectors: vec_id and embedding; queries: vec_id of the rows that ask; other columns are
    ignored. Ranks count from 1, nearest first, ties by the smaller vec_id. A query's own
    id is no candidate. Vectors that are null, empty, zero or not finite throughout take
    no part, nor do rows without an id; vectors of another length are no candidates. Rows
    that repeat an id and a vector count once; of several vectors under one id each asks
    and is found, and the nearest pair of ids counts. Buckets of any size are searched
    whole, cut into blocks of candidates and queries that meet in pairs.
    """
    good = (
        vectors.select("vec_id", "embedding")
        .where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .withColumn("hash", F.xxhash64("embedding"))
    )
    same = ["hash", "embedding"]
    # The smallest id names a vector; k + 1 members can be in a result, one the query.
    members = _ranked(good.distinct(), same, ["vec_id"], k + 1, "place")
    first = Window.partitionBy(*same)
    members = cut(members.withColumn("id", F.min("vec_id").over(first)))
    distinct = members.where("place = 1").withColumn("dim", F.size("embedding"))
    asking = good.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    named = members.where("place = 1").select(*same, "id")
    asking = lookup_join(asking.distinct(), named, same, "inner", ["vec_id"])
    asking = cut(asking.select("vec_id", "id"))
    asked = distinct.join(asking.select("id").distinct(), "id", "left_semi")
    base = _dealt(distinct, 1, tables, hashes, seed)
    probes = _dealt(asked, axes, tables, hashes, seed)
    key = ["dim", "table", "bucket"]
    ours = base.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    theirs = probes.groupBy(*key).agg(F.count(F.lit(1)).alias("m"))
    sizes = cut(
        ours.join(theirs, key).select(
            *key,
            F.ceil(F.col("n") / BLOCK).alias("part"),
            F.ceil(F.col("m") / QUERY_BLOCK).alias("query_part"),
        )
    )
    spread = [*key, "part", "query_part"]
    pairs = (
        _blocked(base, sizes, "part", "query_part")
        .groupBy(*spread)
        .cogroup(_blocked(probes, sizes, "query_part", "part").groupBy(*spread))
        .applyInArrow(_ranker(k + 1), "query long, id long, score double")
    )
    # The exact score of a pair is the same in every block, so repeats agree.
    found = pairs.groupBy("query", "id").agg(F.max("score").alias("score"))
    order = [F.col("score").desc(), "id"]
    found = _ranked(found, ["query"], order, k + 1, "near").drop("near")
    hits = (
        found.join(members.select("id", F.col("vec_id").alias("found")), "id")
        .join(asking.select(F.col("id").alias("query"), "vec_id"), "query")
        .where(F.col("found") != F.col("vec_id"))
        .groupBy(F.col("vec_id").alias("query_id"), "found")
        .agg(F.max("score").alias("score"))
    )
    order = [F.col("score").desc(), "found"]
    return _ranked(hits, ["query_id"], order, k, "rank").select(
        "query_id", "rank", F.col("found").alias("vec_id"), "score"
    )
