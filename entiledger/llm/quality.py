"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

Terms of a text are its hashed byte trigrams and its shape: binned shares of capitals,
digits, marks, repeated words and the like. Weighted term counts of a bounded sample of
labelled documents are factored once on the driver, which gives a small projection; the
projection and the sample's vectors are broadcast, both of fixed size. Every document
then gets exact cosine products with all labelled vectors, in blocks, and its nearest
ones vote by similarity.

Terms, projection and vectors are rounded to whole multiples of a power of two, small
enough for all sums of products to be exact in double precision. So a score depends on
the text alone, not on the block it is in nor on the order of sums, and equal cosines
are equal.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

#: Hashed trigrams, and bins of each shape figure.
GRAMS = 2048
BINS = 8
#: Labelled documents of each class that are learnt from at most; latent dimensions.
SAMPLE = 2000
RANK = 48
#: Units in one of a term and of a projection's entry, and of a vector's entry: products
#: of the first are below 2**26 and their sums below 2**38, of the second 2**40 and 2**46.
UNITS, FINE = 1 << 12, 1 << 20
#: Neighbours that vote, and with them all that are as near as the last; power of the
#: similarity that weighs a vote. These and SHAPE are chosen by `validated`.
NEIGHBOURS = 7
POWER = 24
#: Scores from here on stand for label 1.
THRESHOLD = 0.3
#: How much the shape weighs beside the trigrams.
SHAPE = 2.0
#: Bytes of text, and documents, that are turned into counts at once.
BLOCK = 1 << 20
ROWS = 512

KINDS = np.zeros(256, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = 1
KINDS[65:91] = 2
KINDS[97:123] = 3
KINDS[48:58] = 4
KINDS[128:] = 5
KINDS[[33, 44, 46, 58, 59, 63, 39, 34, 45]] = 6
FIGURES = 11


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _figures(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape of each text, every figure from 0 to 1: shares of bytes and of words."""
    n = len(ends) - 1
    doc = np.repeat(np.arange(n), np.diff(ends))
    kind = KINDS[flat]
    by_kind = np.bincount(doc * 8 + kind, minlength=8 * n).reshape(n, 8)
    size = by_kind.sum(1)
    gap = kind == 1
    edge = np.ones(len(flat) + 1, bool)
    edge[1:-1] = doc[1:] != doc[:-1]
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= gap[:-1]
    after[:-1] |= gap[1:]
    at = np.flatnonzero(before & ~gap)
    end = np.flatnonzero(after & ~gap)
    letters = by_kind[:, 2] + by_kind[:, 3] + by_kind[:, 5]
    out = np.zeros((n, FIGURES))
    out[:, 0] = _ratio(by_kind[:, 2], letters)
    out[:, 1] = _ratio(by_kind[:, 4], size)
    out[:, 2] = np.minimum(1, 4 * _ratio(by_kind[:, 6], size))
    out[:, 3] = np.minimum(1, 4 * _ratio(by_kind[:, 0] + by_kind[:, 7], size))
    out[:, 4] = _ratio(by_kind[:, 1], size)
    out[:, 10] = np.minimum(1, np.log1p(size) / 12)
    if not len(at):
        return out
    word_doc = doc[at]
    words = np.bincount(word_doc, minlength=n)
    mixed = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(flat)) - at[np.maximum(np.cumsum(before & ~gap) - 1, 0)]
    turn = (place % 57).astype(np.uint64)
    mixed = np.where(gap, np.uint64(0), mixed >> turn | mixed << (np.uint64(63) - turn))
    code = np.add.reduceat(mixed, at)

    def share(mask: np.ndarray) -> np.ndarray:
        return _ratio(np.bincount(word_doc[mask], minlength=n), words)

    for column, back in ((5, 1), (6, 2)):
        same = np.zeros(len(at), bool)
        same[back:] = (code[back:] == code[:-back]) & (
            word_doc[back:] == word_doc[:-back]
        )
        out[:, column] = share(same)
    order = np.lexsort((code, word_doc))
    new = np.ones(len(at), bool)
    new[1:] = (code[order][1:] != code[order][:-1]) | (
        word_doc[order][1:] != word_doc[order][:-1]
    )
    out[:, 7] = _ratio(np.bincount(word_doc[order][new], minlength=n), words)
    long = np.bincount(word_doc, end - at + 1, n)
    out[:, 8] = np.minimum(1, _ratio(long, words) / 16)
    out[:, 9] = share(np.isin(kind[end], (0, 6)))
    return out


def _bins(figures: np.ndarray) -> np.ndarray:
    """Each figure shared out between the two bins that it lies between."""
    n, many = figures.shape
    place = figures * (BINS - 1)
    low = np.minimum(place.astype(int), BINS - 2)
    rest = place - low
    out = np.zeros((n, many, BINS))
    rows, columns = np.indices((n, many))
    out[rows, columns, low] = 1 - rest
    out[rows, columns, low + 1] += rest
    return out.reshape(n, -1)


def _terms_of(texts: list[bytes]) -> np.ndarray:
    """Weighted terms of a few texts."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    n = len(texts)
    grams = np.zeros((n, GRAMS))
    if len(flat) > 2:
        doc = np.repeat(np.arange(n), np.diff(ends))
        wide = flat.astype(np.uint32)
        code = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAMS.bit_length() + 1)
        inside = doc[2:] == doc[:-2]
        at = doc[2:][inside] * GRAMS + code[inside]
        grams = np.bincount(at, minlength=n * GRAMS).reshape(n, GRAMS).astype(float)
    grams = np.sqrt(grams)
    size = np.linalg.norm(grams, axis=1, keepdims=True)
    grams /= np.where(size > 0, size, 1)
    shape = _bins(_figures(flat, ends)) * (SHAPE / np.sqrt(FIGURES))
    return np.hstack([grams, shape]).astype(np.float32)


def terms(texts: list[str | None]) -> np.ndarray:
    """A row of weighted terms for each text; a null counts as empty."""
    coded = [t.encode() if t else b"" for t in texts]
    out, first, size = [], 0, 0
    for i, text in enumerate(coded):
        size += len(text)
        if size >= BLOCK or i - first + 1 >= ROWS or i + 1 == len(coded):
            out.append(_terms_of(coded[first : i + 1]))
            first, size = i + 1, 0
    width = GRAMS + FIGURES * BINS
    return np.vstack(out) if out else np.zeros((0, width), np.float32)


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document may not be learnt from; false for a null doc_id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def accepted(score: Column) -> Column:
    """Whether a score stands for label 1."""
    return score >= THRESHOLD


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(label, terms) of up to `size` labelled training documents of each class.

    They are those whose hashed doc_id is smallest. Labels other than 0 and 1 are left
    out; of several labels or texts of one doc_id the smallest counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .where(F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
    )
    picked = [
        known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id")
        for c in (0, 1)
    ]
    few = picked[0].limit(size).union(picked[1].limit(size))

    @F.pandas_udf(BinaryType())
    def coded(texts: pd.Series) -> pd.Series:
        rows = terms(texts.tolist()).astype(np.float16)
        return pd.Series([r.tobytes() for r in rows], dtype=object)

    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(few), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "label", coded("text").alias("terms"))
    )


def _collected(docs: DataFrame, labels: DataFrame, size: int) -> tuple:
    """Terms and labels of the sample, in order of doc_id; about 4 KB for each document."""
    rows = sorted(sample(docs, labels, size).collect(), key=lambda r: r.doc_id)
    if not rows:
        return np.zeros((0, GRAMS + FIGURES * BINS)), np.zeros(0)
    matrix = np.stack([np.frombuffer(r.terms, np.float16) for r in rows])
    return matrix.astype(np.float64), np.array([r.label for r in rows], np.float64)


def _projection(matrix: np.ndarray) -> np.ndarray:
    """Latent axes of the terms, in whole units."""
    _, axes = np.linalg.eigh(matrix.T @ matrix)
    return np.rint(axes[:, ::-1][:, :RANK] * UNITS)


def _vectors(rows: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Unit vectors of rows of terms, in whole units."""
    latent = np.rint(rows.astype(np.float64) * UNITS) @ projection
    size = np.sqrt((latent * latent).sum(axis=1, keepdims=True))
    return np.rint(latent / np.where(size > 0, size, 1) * FINE)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> SimpleNamespace:
    """Projection and labelled vectors, from at most 2 * size documents."""
    matrix, known = _collected(docs, labels, size)
    if not len(known):
        return SimpleNamespace(projection=None, vectors=None, labels=None)
    projection = _projection(matrix)
    vectors = _vectors(matrix, projection)
    return SimpleNamespace(projection=projection, vectors=vectors, labels=known)


def _voted(near: np.ndarray, labels: np.ndarray, neighbours: int, power: int) -> np.ndarray:
    """Weighted share of label 1 among the nearest of each row, ties of the last included."""
    k = min(neighbours, near.shape[1])
    last = np.partition(near, near.shape[1] - k, axis=1)[:, [-k]]
    row, column = np.nonzero(near >= last)
    weight = (near[row, column] / float(FINE * FINE)).clip(1e-6) ** power
    votes = np.bincount(row, weight * labels[column], len(near))
    return votes / np.bincount(row, weight, len(near))


def validated(
    docs: DataFrame, labels: DataFrame, choices: list[tuple[int, int, float]], size: int = SAMPLE
) -> list[float]:
    """Mean accuracy over both labels of each (neighbours, power, shape weight).

    Every document of the sample is voted on by the others (leave one out), so only labels
    that may be learnt from are used. The projection, which knows no labels, is fitted
    once for each shape weight.
    """
    matrix, known = _collected(docs, labels, size)
    near, out = {}, []
    for neighbours, power, shape in choices:
        if shape not in near:
            terms_ = matrix.copy()
            terms_[:, GRAMS:] *= shape / SHAPE
            vectors = _vectors(terms_, _projection(terms_))
            near[shape] = vectors @ vectors.T
            np.fill_diagonal(near[shape], -FINE * FINE)
        right = (_voted(near[shape], known, neighbours, power) >= THRESHOLD) == known
        out.append(float(np.mean([right[known == c].mean() for c in (0, 1)])))
    return out


def vote(model: SimpleNamespace, texts: list[str | None]) -> np.ndarray:
    """Score of each text: the weighted share of label 1 among its neighbours."""
    if model.projection is None:
        return np.full(len(texts), 0.5)
    out = [np.zeros(0)]
    for first in range(0, len(texts), ROWS):
        block = _vectors(terms(texts[first : first + ROWS]), model.projection)
        out.append(_voted(block @ model.vectors.T, model.labels, NEIGHBOURS, POWER))
    return np.concatenate(out).clip(0, 1)


def score(docs: DataFrame, model: SimpleNamespace, into: str = "score") -> DataFrame:
    """docs with a score from 0 to 1, higher where label 1 is likelier.

    Every whole text is scored by itself; a null counts as empty, and an empty text is
    scored by its shape. Equal texts get equal scores, and labelled texts that are as near
    as the last neighbour all vote. A model without labelled rows gives 0.5. A column that is already called `into` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(vote(shared.value, texts.tolist()))

    return docs.withColumn(into, of(F.col("text")))
