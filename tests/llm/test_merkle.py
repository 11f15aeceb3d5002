import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entiledger.llm import merkle


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof(tree, place):
    out = []
    for nodes in tree[:-1]:
        first = place // 3 * 3
        run = nodes[first : first + 3]
        out.append((place - first, run[: place - first] + run[place - first + 1 :]))
        place //= 3
    return out


def fold(value, steps):
    for slot, others in steps:
        value = digest([*others[:slot], value, *others[slot:]])
    return value


def plain(docs):
    """(doc_id, source, leaf, subroot, root, proof, folded root) of (row, new text) pairs."""
    parts = defaultdict(list)
    for (i, text, lang, source, n), fresh in docs:
        old, new = (leaf([i, source, lang, n, t]) for t in (text, fresh))
        parts[source].append((i is not None, i or 0, old, new))
    order = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([r[2] for r in sorted(parts[s])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for place, (known, i, old, new) in enumerate(sorted(parts[s])):
            steps = proof(trees[s], place) + proof(top, at)
            out.append(
                (i if known else None, s, old, trees[s][-1][0], top[-1][0], steps, fold(new, steps))
            )
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted(
        (
            (r.key, r.part, r.leaf, r.subroot, r.root,
             [(s.slot, list(s.others)) for s in r.proof], r.folded_root)
            for r in df.collect()
        ),
        key=repr,
    )


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of nine, so that a few hundred leaves take several passes."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)


def made(sizes):
    return [
        (s * 1000 + i, f"text\n{i}\né", "en", f"src{s}" if s else None, i)
        for s, size in enumerate(sizes)
        for i in range(size)
    ]


def test_against_whole_trees(spark, small_blocks):
    docs = made([4, 200, 1, 9, 10, 27, 81, 3, 2, 28, 82, 1])
    docs += [(None, None, None, None, None), (None, "", "", "", 0), (3, "\n", None, "\U0001f600", 1)]
    docs += [docs[5]] * 3 + [(5, "other", "en", None, 4)] * 2
    want = plain([(d, d[1].replace("\n", "") if d[1] else d[1]) for d in docs])
    df = spark.createDataFrame(docs, SCHEMA).repartition(7)
    wide = df.withColumns({c: F.lit("x") for c in ("digest", "fresh", "pos", "tree", "row", "key")})
    fresh = F.replace("text", F.lit("\n"), F.lit(""))
    assert rows_of(merkle.manifest(wide, changed={"text": fresh})) == want


def test_shuffled_joins(spark, small_blocks, broadcast_up_to):
    broadcast_up_to(-1)
    docs = made([0, 300, 2, 2, 2])
    df = spark.createDataFrame(docs, SCHEMA)
    got = rows_of(merkle.manifest(df))
    assert got == plain([(d, d[1]) for d in docs])
    assert {r[4] for r in got} == {r[6] for r in got}


@pytest.mark.parametrize("sizes", [[0, 1], [0, 2], [0, 1, 1], [0, 1, 1, 1, 1, 1]])
def test_small_tables(spark, sizes):
    docs = made(sizes)
    got = rows_of(merkle.manifest(spark.createDataFrame(docs, SCHEMA)))
    assert got == plain([(d, d[1]) for d in docs])


def test_no_rows(spark):
    done = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert done.collect() == []
    names = {"key", "part", "leaf", "subroot", "root", "proof", "folded_root"}
    assert set(done.columns) == names


def test_states_are_resumed():
    parent = merkle.Parent(["a", "b", "c"])
    assert parent.digest == digest("abc")
    assert [parent.replaced(i, "x") for i in range(3)] == [
        digest("xbc"), digest("axc"), digest("abx"),
    ]
    assert [parent.replaced(i, c) for i, c in enumerate("abc")] == [parent.digest] * 3
