"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one code point have reduced
words that are equal or differ by one symbol, and the one-edit neighbourhood of a reduced
word is small, because its alphabet is. So every different reduced word generates its
whole neighbourhood, the neighbourhoods are joined with the reduced vocabulary, and the
words behind both sides are compared as they are written.

Neighbours travel as polynomial hashes modulo 2**64, which follow from the hash of the
word by arithmetic on its prefixes, for all words of a length at once. A collision only
adds a comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.llm.common import cut
from entiledger.operators.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between runs of letters, once A-Z are lower-case.
GAP = "[^a-zÀ-ÿ]+"
SYMBOLS = 6
#: Symbols of neighbourhoods that a task holds at a time.
BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): the maximal runs of letters of whole texts, A-Z in lower case.

    Letters are A-Z, a-z and U+00C0 to U+00FF. A null or empty text has none; rows that
    repeat a document repeat its runs. Other columns are left out.
    """
    lower = F.translate(F.col(text), UPPER, LOWER)
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.explode(F.split(lower, GAP)).alias("run")
    ).where("run <> ''")


def slipped(doc_id: Column, run: Column, every: int = 97) -> Column:
    """The run without one code point if ``every`` divides the crc32 of `<doc_id>:<run>`.

    That crc32 also names the place. A run of a null doc_id stays as it is.
    """
    mark = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    place = (mark % F.char_length(run)).cast("int")
    cut_out = F.concat(F.substr(run, F.lit(1), place), F.substr(run, place + 2))
    return F.when(mark % every == 0, cut_out).otherwise(run)


def counted(
    words: DataFrame, word: Column, min_length: int = 5, min_count: int = 3
) -> DataFrame:
    """(word, n): the different words that are long and frequent enough.

    Counts are taken map-side first, so a hot word costs a row for each task.
    """
    return (
        words.select(word.alias("word"))
        .where(F.char_length("word") >= min_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length, in blocks."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, BLOCK // max(1, int(length)))
        for first in range(0, len(places), step):
            part = places[first : first + step]
            joined = "".join([words[i] for i in part])
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            yield part, points.reshape(len(part), length)


def reduced(points: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols 1 to ``symbols`` of code points, by a multiplicative hash."""
    mixed = (points.astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(symbols)) >> np.uint64(32)) + np.uint64(1)


def _prefixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and the hashes of all prefixes of each row."""
    rows, length = symbols.shape
    powers = np.full(length + 1, _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(symbols * powers[:length], axis=1, dtype=np.uint64, out=sums[:, 1:])
    return powers, sums


def hashed(symbols: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols."""
    return _prefixes(symbols)[1][:, -1]


def neighbourhood(
    symbols: np.ndarray, count: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of all that is at most one edit away from each row, each once.

    Of equal symbols in a row the last is deleted and a new one goes behind them, so no
    neighbour comes twice.
    """
    rows, length = symbols.shape
    powers, sums = _prefixes(symbols)
    whole = sums[:, -1:]
    yield np.arange(rows), whole[:, 0]
    if length:
        last = np.ones(symbols.shape, bool)
        last[:, :-1] = symbols[:, 1:] != symbols[:, :-1]
        shorter = sums[:, :-1] + (whole - sums[:, 1:]) * _UNBASE
        yield np.nonzero(last)[0], shorter[last]
    tail = (whole - sums) * _BASE
    for symbol in np.arange(1, count + 1, dtype=np.uint64):
        other = symbols != symbol
        replaced = whole + (symbol - symbols) * powers[:length]
        yield np.nonzero(other)[0], replaced[other]
        ahead = np.ones(sums.shape, bool)
        ahead[:, :-1] = other
        longer = sums + symbol * powers + tail
        yield np.nonzero(ahead)[0], longer[ahead]


def _reduce(batches: Iterator, symbols: int) -> Iterator:
    for batch in batches:
        words = batch.column("word").to_pylist()
        names = np.empty(len(words), object)
        hashes = np.empty(len(words), np.int64)
        for places, points in _by_length(words):
            coded = reduced(points, symbols)
            hashes[places] = hashed(coded).view(np.int64)
            letters = (coded + np.uint64(96)).astype(np.uint8)
            names[places] = [bytes(row).decode() for row in letters]
        columns = [pa.array(names, pa.string()), pa.array(hashes)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["word", "n", "r", "h"])


def _adjacent(batches: Iterator, symbols: int) -> Iterator:
    for batch in batches:
        names = batch.column("r")
        words = names.to_pylist()
        for places, points in _by_length(words):
            coded = points.astype(np.uint64) - np.uint64(96)
            own = hashed(coded).view(np.int64)
            for rows, found in neighbourhood(coded, symbols):
                found = found.view(np.int64)
                # Of two that generate each other the one of the larger hash keeps the pair.
                kept = found <= own[rows]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(places[rows[kept]])), pa.array(found[kept])],
                    ["r", "y"],
                )


def near(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): each ordered pair of words exactly one edit apart.

    words: different words, none null, with their counts. An edit inserts, deletes or
    replaces one code point. The number of neighbours of a reduced word goes with its
    length; how many words share a reduced one falls with the number of symbols.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = cut(
        words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(
            lambda b: _reduce(b, symbols), "word string, n long, r string, h long"
        )
    )
    # Few bytes become many rows here, so the tasks must not be merged by bytes.
    names = coded.select("r").distinct().repartition(parts, "r")
    pairs = names.mapInArrow(lambda b: _adjacent(b, symbols), "r string, y long")
    ends = coded.select(
        F.col("h").alias("y"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    same = F.col("h") == F.col("y")
    apart = F.levenshtein("word", "other", 1) == 1
    found = (
        pairs.join(ends, "y")
        .join(coded, "r")
        .where((~same | (F.col("word") < F.col("other"))) & apart)
    )
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(
            F.col("other").alias("word"),
            F.col("other_n").alias("n"),
            F.col("word").alias("other"),
            F.col("n").alias("other_n"),
        ),
    )
    return found.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each chain of forms.

    Every round doubles the steps that are taken; a chain of forms is at most as long as
    the logarithm of the largest count. Forms that very many words lead to are spread.
    """
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = lookup_join(at, ahead, "root", "left", ["word"])
        at = cut(
            moved.select(
                "word",
                F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("_moved"),
            )
        )
        if at.where("_moved").isEmpty():
            return at.drop("_moved")
        at = at.drop("_moved")


def variants(words: DataFrame, ratio: int = 2, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for words with their counts.

    ``n_near`` counts the words one edit apart. The form is the most frequent of them
    (of equal ones the first in code-point order) if it has at least ``ratio`` times the
    word's count, else null; the root is what following the forms ends at, the word
    itself if it has none. words holds each word once; with none there is no row.
    """
    words = cut(words.select("word", "n"))
    ranked = F.struct((-F.col("other_n")).alias("_n"), F.col("other").alias("_w"))
    alone = words.select("word", "n", F.lit(None).cast("string"), F.lit(None).cast("long"))
    listed = near(words, symbols).union(alone)
    best = listed.groupBy("word").agg(
        F.max("n").alias("n"),
        F.count("other").alias("n_near"),
        F.min(F.when(F.col("other").isNotNull(), ranked)).alias("_best"),
    )
    fits = -F.col("_best._n") >= ratio * F.col("n")
    formed = cut(
        best.select(
            "word",
            "n",
            "n_near",
            F.when(fits, F.col("_best._w")).alias("form"),
            F.when(fits, -F.col("_best._n")).alias("form_n"),
        )
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
