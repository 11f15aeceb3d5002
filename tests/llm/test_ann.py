import math

import numpy as np
import pytest

from entiledger.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, label int, id long, bucket long, score double"


def frame(spark, rows):
    made = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 1, 0.5)
            for i, v in rows]
    return spark.createDataFrame(made, SCHEMA)


def cosine(a, b):
    a, b = (np.array(v, np.float32).astype(np.float64) for v in (a, b))
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))


def brute(rows, asking, k):
    """query -> [(vec_id, score)] by all pairs."""
    out = {}
    for q in asking:
        best = {}
        for i, v in rows:
            if i != q:
                for j, own in rows:
                    if j == q and len(own) == len(v):
                        best[i] = max(best.get(i, -2), round(cosine(own, v), 12))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_of_the_query(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = found(queries.QUERIES["op6_ann"](spark, folder))
    asking = np.flatnonzero(ids % 50 == 0)
    assert set(got) == set(ids[asking].tolist())
    hit = 0
    for q in asking:
        near = x @ x[q]
        near[q] = -2
        want = set(ids[np.argsort(-near)[:5]].tolist())
        mine = got[int(ids[q])]
        assert len(mine) == 5
        hit += len(want & {i for i, _ in mine})
        assert all(abs(s - near[np.flatnonzero(ids == i)[0]]) < 1e-9 for i, s in mine)
    assert hit / (5 * len(asking)) >= 0.9


def test_two_hashes(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asking = vectors.where("vec_id % 50 = 0")
    all_axes = ann.nearest(vectors, asking, 5, tables=1, hashes=1, axes=64)
    few = ann.nearest(vectors, asking, 5, tables=6, hashes=2, axes=24)
    want, got = found(all_axes), found(few)
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    assert hit / sum(map(len, want.values())) > 0.5


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_small_blocks_find_the_same(spark, monkeypatch, size):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5)) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(20)]
    rows += [(200 + i, 2 * np.float32(rows[5][1])) for i in range(4)]
    monkeypatch.setattr(ann, "BLOCK", size)
    monkeypatch.setattr(ann, "QUERY_BLOCK", size)
    df = frame(spark, rows)
    asking = [i for i, _ in rows if i % 5 == 0]
    got = found(ann.nearest(df, df.where("vec_id % 5 = 0"), 5, tables=1, axes=8))
    want = brute(rows, asking, 5)
    assert {q: [s for _, s in v] for q, v in got.items()} == {
        q: [s for _, s in v] for q, v in want.items()
    }
    assert got == want


@pytest.mark.parametrize("size", [64, 4096])
@pytest.mark.parametrize("direction", [[0, 1, 0, 0], [1, 2, -3, 5]])
def test_parallel_vectors_tie_to_the_smaller_id(spark, monkeypatch, size, direction):
    rows = [(i, [(i + 1) * x for x in direction]) for i in range(300)]
    rows += [(1000 + i, [1, 0, i, 1]) for i in range(5)]
    monkeypatch.setattr(ann, "BLOCK", size)
    monkeypatch.setattr(ann, "QUERY_BLOCK", size)
    monkeypatch.setattr(ann, "PAIR_CELLS", 1000)
    df = frame(spark, rows)
    got = found(ann.nearest(df, df.where("vec_id in (2, 150, 299)"), 5, tables=1, axes=4))
    assert got == brute(rows, [2, 150, 299], 5)
    assert [i for i, _ in got[150]] == [0, 1, 2, 3, 4]


def test_edge_cases(spark):
    rows = [(0, [1, 0, 0]), (1, [1, 0, 0]), (2, [0, 0, 0]), (3, None), (4, []), (5, [1, None, 2]),
            (6, [float("nan"), 1, 1]), (7, [float("inf"), 0, 0]), (None, [1, 0, 0]), (8, [1, 1]),
            (10, [2, 0, 0]), (10, [2, 0, 0]), (11, [-1, 0, 0]), (12, [3e38, 1, 0]), (13, [1e-38, 0, 0])]
    df = frame(spark, rows)
    good = [(i, v) for i, v in rows if i in (0, 1, 8, 10, 11, 12, 13)]
    asking = [0, 8, 10, 12]
    got = found(ann.nearest(df, df.where("vec_id in (0, 2, 3, 8, 10, 12)"), 3, tables=1, axes=4))
    want = {q: v for q, v in brute(good, asking, 3).items() if v}
    assert got == want
    assert found(ann.nearest(df.limit(0), df, 3)) == {}
    assert found(ann.nearest(df, df.limit(0), 3)) == {}
    alone = frame(spark, [(0, [1, 2])])
    assert found(ann.nearest(alone, alone, 3)) == {}


def test_hadamard_is_orthogonal():
    for n in (1, 2, 8, 64):
        h = ann.hadamard(np.eye(n))
        assert np.allclose(h @ h.T, np.eye(n))
    x = np.random.default_rng(0).normal(size=(4, 50))
    assert np.allclose(
        np.linalg.norm(ann.rotated(x, 1, 0, 3), axis=1), np.linalg.norm(x, axis=1)
    )
