"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

All different words of a block lie in one flat array of symbols. A round looks up the
rank of every adjacent pair by binary search over the sorted pair keys, takes the
smallest rank of each word, and merges all its occurrences at once, from the left where
they overlap. A pair that a merge makes ranks behind that merge, so rounds give what one
merge at a time gives. Words without a known pair leave the array.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entiledger.llm.common import spare

#: Fixed value: the public pattern that splits a text before byte-level merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Bytes of texts that are encoded together.
BLOCK = 1 << 21
NO_RANK = np.int64(1 << 62)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    shown = {chr(b): b for b in plain}
    return shown | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> SimpleNamespace:
    """Tables of a byte-level tokenizer file in JSON, flat so that they are small.

    byte_ids: token of each byte. pair_keys, pair_ranks: the pairs of tokens in order and
    their ranks. merged: the token that each rank makes. token_bytes, token_ends: what
    each token stands for. special: tokens that are cut out of a text first.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    of = byte_characters()
    size = 1 + max([*vocab.values(), *special.values()])
    pieces = [b""] * size
    for token, i in vocab.items():
        pieces[i] = bytes(of[c] for c in token)
    for token, i in special.items():
        pieces[i] = token.encode()
    byte_ids = np.zeros(256, np.int64)
    for c, b in of.items():
        byte_ids[b] = vocab[c]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return SimpleNamespace(
        byte_ids=byte_ids,
        pair_keys=keys[order],
        pair_ranks=order.astype(np.int64),
        merged=merged,
        token_bytes=b"".join(pieces),
        token_ends=np.cumsum([0, *map(len, pieces)]),
        special=special,
    )


def _ranks(v: SimpleNamespace, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair, NO_RANK where it is none."""
    keys = left << 32 | right
    at = np.searchsorted(v.pair_keys, keys)
    at[at == len(v.pair_keys)] = 0
    return np.where(v.pair_keys[at] == keys, v.pair_ranks[at], NO_RANK)


def _take(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, sizes) of the elements of ragged rows, whose borders are ends."""
    starts, sizes = ends[rows], ends[rows + 1] - ends[rows]
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum()), sizes


def merge_words(v: SimpleNamespace, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the token ids of all words one after the other, and their borders."""
    sizes = np.array([len(w) for w in words], np.int64)
    sym = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    rank = np.full(len(sym), NO_RANK)
    pair = np.flatnonzero(word[1:] == word[:-1])
    rank[pair] = _ranks(v, sym[pair], sym[pair + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(sym)])
        least = np.minimum.reduceat(rank, starts)
        over = np.repeat(least == NO_RANK, sizes)
        if over.any():
            done.append((word[over], sym[over]))
            sym, word, rank = sym[~over], word[~over], rank[~over]
            sizes, least = sizes[least != NO_RANK], least[least != NO_RANK]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(least, sizes))
        new_run = np.r_[True, np.diff(hit) != 1]
        run_start = hit[new_run][np.cumsum(new_run) - 1]
        hit = hit[(hit - run_start) % 2 == 0]
        sym[hit] = v.merged[rank[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        at = hit - np.arange(len(hit))
        sym, word, rank = sym[keep], word[keep], rank[keep]
        new = np.zeros(len(sym), bool)
        new[at] = new[at[at > 0] - 1] = True
        rank[new] = NO_RANK
        inner = np.flatnonzero(new[:-1])
        inner = inner[word[inner] == word[inner + 1]]
        rank[inner] = _ranks(v, sym[inner], sym[inner + 1])
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    word = np.concatenate([w for w, _ in done])
    order = np.argsort(word, kind="stable")
    ids = np.concatenate([s for _, s in done])[order].astype(np.int32)
    return ids, np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))]


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def encode_texts(v: SimpleNamespace, texts: list[str | None]) -> list[np.ndarray]:
    """Token ids of each text; none for a null. All texts are encoded together."""
    names = sorted(v.special, key=len, reverse=True)
    pattern = regex.compile(PATTERN)
    either = regex.compile("(" + "|".join(map(regex.escape, names)) + ")")
    number, rows = _Numbered(), []
    for text in texts:
        pieces: list = pattern.findall(text or "")
        if any(s in (text or "") for s in names):
            pieces = []
            for part in either.split(text):
                known = v.special.get(part)
                pieces += pattern.findall(part) if known is None else [known]
        rows.append(np.array(list(map(number.__getitem__, pieces)), np.int32))
    words = [b"" if isinstance(w, int) else w.encode() for w in number]
    wholes = [(i, w) for i, w in enumerate(number) if isinstance(w, int)]
    number.clear()
    ids, ends = merge_words(v, words)
    if wholes:
        ids = np.insert(ids, [ends[i] for i, _ in wholes], [w for _, w in wholes])
        ends = ends + np.searchsorted([i for i, _ in wholes], np.arange(len(ends)))
    return [ids[_take(ends, row)[0]] for row in rows]


def decode_ids(v: SimpleNamespace, ids: np.ndarray) -> str:
    """The text of token ids; ids outside the vocabulary are left out."""
    ids = np.asarray(ids, np.int64)
    ids = ids[(ids >= 0) & (ids < len(v.token_ends) - 1)]
    places, _ = _take(v.token_ends, ids)
    flat = np.frombuffer(v.token_bytes, np.uint8)
    return flat[places].tobytes().decode("utf-8", errors="replace")


def share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of a file that only the driver reads, for all executors."""
    return spark.sparkContext.broadcast(load(path))


def _mapped(docs: DataFrame, read: str, fields: str, of: Callable) -> DataFrame:
    """docs with new columns that a function makes of the values of one column.

    Texts come in runs of about BLOCK bytes, a longer one by itself, and each run goes
    back before the next is taken up, so memory follows the longest text and not the
    number of rows. Columns that are already called like new ones are replaced.
    """
    added = StructType.fromDDL(fields)
    kept = [c for c in docs.columns if c not in added.names]
    inner = spare(docs, "_read")
    source = docs.select(*kept, F.col(read).alias(inner))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(inner)
            listed = pa.types.is_list(values.type)
            length = pc.list_value_length if listed else pc.binary_length
            sizes = length(values).fill_null(0).to_numpy()
            first = size = 0
            for i, one in enumerate(sizes):
                size += one
                if size < BLOCK and i + 1 < len(sizes):
                    continue
                part = batch.slice(first, i + 1 - first)
                made = of(part.column(inner).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + made, kept + added.names
                )
                first, size = i + 1, 0

    schema = StructType([docs.schema[c] for c in kept] + added.fields)
    return source.mapInArrow(run, schema)


def _listed(rows: list[np.ndarray]) -> pa.Array:
    """An array column of rows of ids."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(
    docs: DataFrame, vocabulary: Broadcast, text: str = "text", into: str = "ids"
) -> DataFrame:
    """docs with the token ids of a text column as array<int>; a null text has none.

    Every row is encoded by itself, so nothing is shuffled, and null, empty, very long
    and repeated texts need no care. A column that is already called `into` is replaced.
    """

    def of(texts: list) -> list[pa.Array]:
        return [_listed(encode_texts(vocabulary.value, texts))]

    return _mapped(docs, text, f"`{into}` array<int>", of)


def decode(
    docs: DataFrame, vocabulary: Broadcast, ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """docs with the text of a column of token ids; a null column gives an empty text."""

    def of(rows: list) -> list[pa.Array]:
        return [pa.array([decode_ids(vocabulary.value, r or []) for r in rows], pa.string())]

    return _mapped(docs, ids, f"`{into}` string", of)


def round_trip(
    docs: DataFrame,
    vocabulary: Broadcast,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """docs encoded and the ids decoded again, in one pass over the texts."""

    def of(texts: list) -> list[pa.Array]:
        rows = encode_texts(vocabulary.value, texts)
        back = [decode_ids(vocabulary.value, r) for r in rows]
        return [_listed(rows), pa.array(back, pa.string())]

    return _mapped(docs, text, f"`{ids}` array<int>, `{decoded}` string", of)
