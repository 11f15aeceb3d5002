import random
import re

import pytest

from entiledger.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    """doc -> (n_words, n_hit, item ids), by looking for every window everywhere."""
    cut = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            cut.setdefault(tuple(w[s : s + window]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for wanted, ids in cut.items():
            for s in range(len(w) - len(wanted) + 1):
                if tuple(w[s : s + len(wanted)]) == wanted:
                    hit.update(range(s, s + len(wanted)))
                    found |= ids
        out[doc, text] = (len(w), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def run(docs, items, window):
    got = decontaminate.overlaps(docs, items, window).collect()
    return {(r.doc_id, r.key): (r.n_words, r.n_hit, r.item_ids) for r in got}, len(got)


def compare(spark, docs_of, pairs, items, window):
    table = spark.createDataFrame(items, "item_id long, text string")
    got, n = run(docs_of(pairs), table, window)
    want = brute(set(pairs), items, window)
    assert n == len(want)
    assert sorted(map(repr, got.values())) == sorted(map(repr, want.values()))
    by_id = {i: v for (i, _), v in got.items()}
    for (i, _), v in want.items():
        if sum(i == j for j, _ in want) == 1:
            assert by_id[i] == v


@pytest.mark.parametrize("blocks", [1, 3])
@pytest.mark.parametrize("window", [1, 2, 4, 13])
def test_against_brute_force(spark, docs_of, monkeypatch, window, blocks):
    rng = random.Random(window)
    if blocks > 1:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4000)
    pool = ["the", "Of", "and", *[f"w{i}" for i in range(12)], "éa", "ÉA"]
    items = [
        (i, " ".join(rng.choices(pool, k=rng.choice([1, 2, 3, 5, 14, 30]))))
        for i in range(25)
    ]
    pairs = []
    for i in range(40):
        text = rng.choices(pool, k=rng.randrange(0, 60))
        if i % 3 == 0:
            text[5:5] = rng.choice(items)[1].split()
        pairs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    compare(spark, docs_of, pairs, items, window)


def test_edge_cases(spark, docs_of):
    items = [(1, None), (2, ""), (3, "..."), (4, "a b"), (4, "c d"), (None, "e f"),
             (6, "a b"), (7, "x " * 20)]
    pairs = [(1, None), (2, ""), (3, "A, b! e f"), (4, "x " * 5000), (5, "e f"), (5, "c d"),
             (None, "a b"), (7, "a a b b a"), (8, "b a")]
    compare(spark, docs_of, pairs, items, 13)
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([*pairs, (7, "a a b b a")])
    assert run(docs, table, 13)[1] == len(pairs)
    assert run(docs.limit(0), table, 13)[1] == 0
    none, n = run(docs, table.limit(0), 13)
    assert n == len(pairs)
    assert all(hit == 0 and ids == [] for _, hit, ids in none.values())


def test_clean_keeps_all_other_rows(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(13))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    long = " ".join(f"q{i}" for i in range(248))
    pairs = [(1, passage), (2, long + " " + passage), (3, None), (3, None), (None, "a b"),
             (6, long[:900] + " " + passage), (None, passage)]
    docs = docs_of(pairs)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [pairs[1], pairs[2], pairs[3], pairs[4]], key=repr
    )


