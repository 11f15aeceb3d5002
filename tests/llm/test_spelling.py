import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from entiledger.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    short, long = sorted((a, b), key=len)
    return short[i:] == long[i + 1 :]


def plain(words, ratio):
    out = []
    form = {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(v, w))
        fits = bool(near) and -near[0][0] >= ratio * n
        form[w] = near[0][1] if fits else None
        out.append((w, n, len(near), form[w], -near[0][0] if fits else None))

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((*row, root(row[0])) for row in out)


def rows_of(df):
    named = df.select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(map(tuple, named.collect()))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(4)
    made = {"".join(rng.choices("abcé", k=rng.randrange(1, 7))) for _ in range(300)}
    made |= {"a" * 300, "a" * 301, "é" * 5, "日本語", "日本", "x", "𝒳y", "𝒴y", "y"}
    return {w: rng.choice([1, 2, 2, 3, 5, 9, 40]) for w in sorted(made)}


@pytest.mark.parametrize("symbols", [1, 2, 6])
def test_against_all_pairs(spark, words, symbols):
    df = spark.createDataFrame(list(words.items()), "word string, n int")
    got = sorted((r.word, r.other) for r in spelling.near(df, symbols).collect())
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))
    assert rows_of(spelling.variants(df, 2, symbols)) == plain(words, 2)


def test_shuffled_joins_and_hot_forms(spark, broadcast_up_to):
    broadcast_up_to(-1)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    words = {"stone": 900} | {f"ston{c}": 3 for c in letters} | {f"s{c}one": 2 for c in letters}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variants(df).collect()
    assert len(got) == 801
    assert all(r.root == "stone" for r in got)
    assert {r.n_near for r in got if r.word == "stone"} == {800}
    assert {r.n_near for r in got if r.word != "stone"} == {400}


def test_neighbourhood_is_whole_and_has_nothing_twice():
    import numpy as np

    rng = random.Random(6)
    for count in (1, 2, 4):
        for length in (0, 1, 2, 5):
            rows = [[rng.randrange(1, count + 1) for _ in range(length)] for _ in range(5)]
            table = np.array(rows, np.uint64).reshape(5, length)

            def key(symbols):
                return int(spelling.hashed(np.array([symbols], np.uint64).reshape(1, -1))[0])

            found = [[] for _ in rows]
            for places, hashes in spelling.neighbourhood(table, count):
                for i, h in zip(places, hashes, strict=True):
                    found[i].append(int(h))
            for row, got in zip(rows, found, strict=True):
                want = {tuple(row)}
                for i in range(length + 1):
                    for c in range(1, count + 1):
                        want.add((*row[:i], c, *row[i:]))
                        if i < length:
                            want.add((*row[:i], c, *row[i + 1 :]))
                    if i < length:
                        want.add((*row[:i], *row[i + 1 :]))
                assert sorted(got) == sorted(key(list(w)) for w in want)


def test_documents(spark, docs_of):
    texts = [
        None, "", "12 .", "Straße STRASSE strasse Éclair éclair ÷×÷×÷ naïve-naïve_naive",
        "word " * 30 + "wort " * 3, "日本語abcde日本", "a" * 50_000, "\x00houses\x00 houses hoUses",
    ]
    pairs = [*enumerate(texts), (None, texts[3]), (3, texts[3]), (3, texts[3])]
    docs = docs_of(pairs).withColumn("run", F.lit("x")).withColumn("word", F.lit("x"))
    runs = spelling.runs(docs)
    slipped = spelling.slipped(F.col("doc_id"), F.col("run"), 3)
    got = {r.word: r.n for r in spelling.counted(runs, slipped, 4, 2).collect()}

    counts = Counter()
    for doc_id, text in pairs:
        lower = (text or "").translate(str.maketrans(spelling.UPPER, spelling.LOWER))
        run = ""
        for c in lower + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if doc_id is not None and h % 3 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    assert got == {w: n for w, n in counts.items() if len(w) >= 4 and n >= 2}
    none = spelling.counted(spelling.runs(docs.limit(0)), slipped)
    assert spelling.variants(none).collect() == []
