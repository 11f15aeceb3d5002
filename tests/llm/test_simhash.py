import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from entiledger.llm import queries, simhash
from entiledger.llm.components import components


def fingerprint(text, shingle=3):
    """The contract word by word, bit by bit."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [now] if now else []
            now = ""
        else:
            now += c
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + shingle]).encode(), seed=42).intdigest()
        for i in range(n)
    ]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > n
    )


def classes(marks, bits=3):
    """Node -> smallest index of its component, by comparing all pairs."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(marks))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_is_brute_force(spark, sf_dir, texts):
    ids = sorted(texts)
    marks = [fingerprint(texts[i]) for i in ids]
    want = {
        (i, f"{m:016x}", ids[c]) for i, m, c in zip(ids, marks, classes(marks), strict=True)
    }
    got = queries.QUERIES["op9_simhash"](spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == want
    assert len(got) == len(ids)


def test_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97} v{i % 31}" for i in range(3000))
    whole = simhash._fingerprint(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 128)
    assert simhash._fingerprint(text, 3) == whole == signed(fingerprint(text))


@pytest.mark.parametrize("half", [0, 1, 0xFFFFFFFF, 0x80000000, 0x12345678, 0x7FFFFFFF])
def test_anchors_cover(half):
    def all_of(values, ball):
        rows, found = simhash.anchors(np.array(values, np.int64), ball)
        return [set(found[rows == i].tolist()) for i in range(len(values))]

    near = [half] + [half ^ 1 << i for i in range(32)]
    (home,) = all_of([half], False)
    assert len(home) == 1
    assert (next(iter(home)) ^ half).bit_count() <= 1
    for ball in all_of(near, True):
        assert home <= ball
        assert len(ball) in (2, 17)


def random_marks(n, seed):
    rng = np.random.default_rng(seed)
    base = [int(x) for x in rng.integers(0, 1 << 63, n)]
    out = list(base)
    for x in base[: n // 2]:
        for flips in (1, 2, 3, 4):
            places = rng.choice(64, flips, replace=False)
            out.append(x ^ sum(1 << int(p) for p in places))
    return out


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_groups_of_given_marks(spark, bits):
    # One place is so crowded that midpoints merge it first.
    center = 0x5A5A5A5A5A5A5A5A
    crowd = [center ^ 1 << i ^ 1 << j for i in range(0, 20) for j in range(i)]
    marks = random_marks(40, 3) + crowd + [0, 0, (1 << 64) - 1]
    rows = [(i, signed(m)) for i, m in enumerate(marks)]
    marked = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(marked, bits).collect()}
    want = classes(marks, bits)
    assert [got[signed(m)] for m in marks] == want


def test_unknown_distance(spark):
    fps = spark.createDataFrame([(1, 1)], "fp long, label long")
    with pytest.raises(ValueError):
        simhash.links(fps, 4)


def test_edge_cases(docs_of):
    docs = docs_of(
        [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (5, "A"), (None, "a"),
         (7, "b c"), (None, "only here and there"), (9, "x " * 50000)]
    )
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == 10
    by = {(r.doc_id, r.fp): r.component_id for r in got}
    assert {c for (i, f), c in by.items() if f == 0} == {1}
    assert by[(None, signed(fingerprint("a")))] == 4
    assert by[(None, signed(fingerprint("only here and there")))] is None
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_survivors(docs_of):
    pairs = [(3, "same text here"), (1, "Same text here"), (1, "Same text here"),
             (2, None), (5, ""), (None, "alone and apart"), (8, "another thing entirely")]
    docs = docs_of(pairs)
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, "Same text here"), (2, None), (None, "alone and apart"),
         (8, "another thing entirely")], key=repr)
    assert simhash.survivors(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, i) for i in range(101, 150)]
    edges = spark.createDataFrame(
        [*chain, *star, (7, 3), (500, 500), (300, 299), (299, 300)], "a long, b long"
    )
    got = {r.node: r.label for r in components(edges).collect()}
    want = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 150)}
    assert got == want | {299: 299, 300: 299}
    assert components(edges.limit(0)).count() == 0
    nulls = edges.select(F.lit(None).cast("long").alias("a"), "b")
    assert components(nulls).count() == 0


def test_a_crowded_half_is_split_by_the_other(spark, broadcast_up_to):
    """Thousands of fingerprints that share a half, low or high, against all pairs."""
    import numpy as np

    broadcast_up_to(-1)
    rng = np.random.default_rng(3)
    other = rng.integers(0, 1 << 32, 1500).astype(np.uint64)
    # Neighbours of some: three bits of the other half, or two there and one in the shared.
    near = other[:200] ^ np.uint64(1 << 3 | 1 << 17 | 1 << 31)
    mixed = (other[200:400] ^ np.uint64(1 << 20 | 1 << 21)) << np.uint64(32)
    shared = np.uint64(0x9ABCDEF0)
    halves = np.concatenate([other, near])
    low = halves << np.uint64(32) | shared
    high = shared << np.uint64(32) | halves
    fps = np.unique(np.concatenate([low, high, mixed | shared ^ np.uint64(1)]))
    assert len(halves) > 5 * simhash.SPLIT
    frame = spark.createDataFrame([(int(f), int(f)) for f in fps.view(np.int64)], "fp long, label long")
    for bits in (1, 3):
        got = {(r.fp, r.other) for r in simhash.links(frame, bits).collect()}
        signed = fps.view(np.int64)
        apart = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
        want = {
            (min(a, b), max(a, b))
            for i, j in zip(*np.nonzero(apart), strict=True)
            if i < j
            for a, b in [(int(signed[i]), int(signed[j]))]
        }
        assert got == want
    assert len(want) >= 600


def test_survivors_keep_columns_of_any_name_and_type(spark):
    data = [(1, "a b c", {"x": 1}, 7), (1, "a b c", {"x": 2}, 8), (2, "a b c", {}, 9), (3, None, None, 1)]
    names = "doc_id long, text string, _own map<string,int>, _simhash_key int"
    docs = spark.createDataFrame(data, names).withColumn("_row", F.lit("r")).withColumn("_id", F.lit(0))
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    got = sorted(kept.collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r._row, r._id) for r in got] == [(1, "r", 0), (3, "r", 0)]
    assert tuple(got[0])[:4] in data[:2] and tuple(got[1])[:4] == data[3]
    again = simhash.survivors(docs.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
