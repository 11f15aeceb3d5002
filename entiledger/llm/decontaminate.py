"""Benchmark decontamination by a prefix-filtered set join, in built-in functions only.

Every benchmark item is cut into windows of `window` consecutive words (a shorter item is
one window). A document contains a window only if it contains all of its shingles, so the
necessary prefix of a window, with its shingles ordered by how rare they are in the whole
corpus, is its rarest one: |S| - ceil(1.0 |S|) + 1 = 1. Only those shingles are joined
with the documents' shingles. A shared shingle fixes where the window would have to
start; the length bound asks for its words to fit in the text, and the words there are
compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.llm.common import cut, text_key

#: What stands between words, after A-Z is lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHINGLE = 3
#: Contaminated documents, two longs each, up to which they are broadcast to be left
#: out; with more of them both sides are shuffled. That is some 50 MB.
BROADCAST_ROWS = 1_000_000
#: Bytes of windows that are broadcast at once; a larger benchmark goes in blocks.
BLOCK_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Words of a text; none of a null."""
    lower = F.translate(text, UPPER, LOWER)
    found = F.array_remove(F.split(lower, GAP), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _token(start: Column, size: int) -> Column:
    """Hash of the words from a place on; fewer at the end of the text."""
    return F.xxhash64(*[F.get(F.col("words"), start + i) for i in range(size)])


def windows(items: DataFrame, window: int) -> DataFrame:
    """(window, len, items) of all different windows, the words space-joined.

    An item without words has none. items lists the different ids, without null.
    """
    cut_up = (
        items.select(
            F.col("item_id").cast("string").alias("item"),
            words(F.col("text")).alias("words"),
        )
        .where(F.size("words") > 0)
        .select(
            "item",
            "words",
            F.explode(
                F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
            ).alias("at"),
        )
        .select("item", F.slice("words", F.col("at"), window).alias("words"))
    )
    return cut_up.groupBy("words").agg(F.collect_set("item").alias("items"))


def _shingles(cut_up: DataFrame, size: int) -> DataFrame:
    """(words, items, offset, size, token) of every shingle of every window."""
    length = F.size("words")
    places = F.sequence(F.lit(0), F.greatest(length - size, F.lit(0)))
    exploded = cut_up.select("words", "items", F.explode(places).alias("offset"))
    tokens = [
        F.when(F.least(F.size("words"), F.lit(size)) == k, _token(F.col("offset"), k))
        for k in range(1, size + 1)
    ]
    return exploded.select(
        "words",
        "items",
        "offset",
        F.least(length, F.lit(size)).alias("size"),
        F.coalesce(*tokens).alias("token"),
    )


def _places(docs: DataFrame) -> DataFrame:
    """(doc_id, key, words, n, pos): a row for each word, and one at pos = n."""
    texts = docs.select(
        "doc_id",
        text_key(F.col("text")).alias("key"),
        words(F.col("text")).alias("words"),
    )
    return texts.select(
        "doc_id",
        "key",
        "words",
        F.size("words").alias("n"),
        F.explode_outer(F.sequence(F.lit(0), F.size("words"))).alias("pos"),
    )


def _probed(places: DataFrame, sizes: list[int]) -> DataFrame:
    """Each place with the tokens that start there, one row for each size."""
    probes = F.array(
        *[
            F.struct(F.lit(k).alias("size"), _token(F.col("pos"), k).alias("token"))
            for k in sizes
        ]
    )
    if len(sizes) == 1:
        probe = places.withColumn("token", _token(F.col("pos"), sizes[0]))
        return probe.withColumn("size", F.lit(sizes[0]))
    return places.select("*", F.explode_outer(probes).alias("probe")).select(
        "doc_id", "key", "words", "n", "pos", "probe.size", "probe.token"
    )


def _hits(docs: DataFrame, prefix: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, key, n, span, items): every occurrence, and for each text one null."""
    probed = _probed(_places(docs), sizes)
    joined = probed.join(
        F.broadcast(prefix.withColumnRenamed("words", "wanted")),
        ["token", "size"],
        "left",
    )
    start = F.col("pos") - F.col("offset")
    length = F.size("wanted")
    here = (
        F.col("wanted").isNotNull()
        & (start >= 0)
        & (start + length <= F.col("n"))
        & (F.slice("words", F.greatest(start, F.lit(0)) + 1, length) == F.col("wanted"))
    )
    last = (F.col("pos") == F.col("n")) & (F.col("size") == sizes[0])
    return joined.select(
        "doc_id",
        "key",
        "n",
        F.when(here, F.struct(start.alias("start"), length.alias("len"))).alias("span"),
        F.when(here, F.col("items")).alias("items"),
        last.alias("last"),
    ).where(F.col("span").isNotNull() | F.col("last"))


def overlaps(
    docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, key, n_words, n_hit, item_ids), a row for each different document.

    docs: doc_id and text; items: item_id and text; other columns are ignored. A document
    word within any occurrence of a window is hit; item_ids are the different ids of
    items with occurring windows, as sorted strings. Rows that agree in doc_id and text
    are one document, and key tells several texts of one doc_id apart. A null or wordless
    text has no words and no hit; an item without words is never found, one without an
    item_id hits words but isn't listed. Empty tables give no rows or no hits.
    """
    cut_up = cut(windows(items, window))
    size = F.length(F.array_join("words", " ")) + 16 * F.size("words") + 64
    total = cut_up.agg(
        F.sum(size + F.size("items") * 32), F.collect_set(F.least(F.size("words"), F.lit(shingle)))
    ).first()
    sizes = sorted(total[1]) or [shingle]
    blocks = 1 + (total[0] or 0) // BLOCK_BYTES
    shingles = _shingles(cut_up, shingle)

    def block(i: int, table: DataFrame) -> DataFrame:
        return table.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == i)

    counts = []
    for i in range(blocks):
        wanted = block(i, shingles).select("token", "size").distinct()
        seen = _probed(_places(docs), sizes).select("token", "size")
        counts.append(seen.join(F.broadcast(wanted), ["token", "size"]))
    known = [
        cut(c.groupBy("token", "size").agg(F.count(F.lit(1)).alias("n"))) for c in counts
    ]
    found = []
    for i in range(blocks):
        ranked = block(i, shingles).join(known[i], ["token", "size"])
        rarest = F.min(F.struct("n", "offset", "token", "size")).alias("rarest")
        prefix = (
            ranked.groupBy("words")
            .agg(rarest, F.first("items").alias("items"))
            .select("words", "items", "rarest.offset", "rarest.token", "rarest.size")
        )
        found.append(_hits(docs, prefix, sizes))
    hits = reduce(DataFrame.union, found)
    spans = F.array_sort(F.collect_set("span"))
    grouped = hits.groupBy("doc_id", "key").agg(
        F.max("n").alias("n_words"),
        spans.alias("spans"),
        F.collect_set("items").alias("lists"),
    )
    end = F.lit(0)
    covered = F.aggregate(
        "spans",
        F.struct(end.alias("end"), end.alias("covered")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
            (
                a["covered"]
                + F.greatest(
                    F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"])
                )
            ).alias("covered"),
        ),
    )
    return grouped.select(
        "doc_id",
        "key",
        F.col("n_words").cast("long").alias("n_words"),
        covered["covered"].cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("lists"))).alias("item_ids"),
    )


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """Whether at least a twentieth of a document's words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The rows of docs that aren't contaminated, all their columns as they are."""
    dirty = (
        overlaps(docs, items, window)
        .where(contaminated(F.col("n_words"), F.col("n_hit")))
        .select(
            F.col("doc_id").alias("_dirty_id"), F.col("key").alias("_dirty_key")
        )
    )
    dirty = cut(dirty)
    if dirty.count() <= BROADCAST_ROWS:
        dirty = F.broadcast(dirty)
    same = docs["doc_id"].eqNullSafe(dirty["_dirty_id"]) & (
        text_key(docs["text"]) == dirty["_dirty_key"]
    )
    return docs.join(dirty, same, "left_anti")
