import hashlib
import random

import pytest

from entiledger.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, pos string, digest string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA)


def kept(turns):
    """conv_ids of maximal conversations, by comparing every prefix."""
    said = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (t[0], t[1])):
        said.setdefault(conv, []).append((role, text))
    out, seen = set(), set()
    for conv, own in sorted(said.items()):
        longer = any(o[: len(own)] == own and len(o) > len(own) for o in said.values())
        if not longer and tuple(own) not in seen:
            out.add(conv)
        seen.add(tuple(own))
    return out


@pytest.mark.parametrize("block", [2, 3, 512])
def test_against_all_prefixes(spark, block):
    rng = random.Random(block)
    turns, logs = [], []
    for _ in range(40):
        logs.append([(rng.choice("ua"), rng.choice("xyz")) for _ in range(rng.randrange(1, 9))])
    logs += [log[: rng.randrange(1, len(log) + 1)] for log in logs]
    logs += [log + [("u", "more")] for log in logs[:10]]
    for conv, log in enumerate(logs):
        shift = rng.choice([0, 5])
        turns += [(conv, shift + i, role, text) for i, (role, text) in enumerate(log)]
    rng.shuffle(turns)
    got = {r.conv_id for r in chat.maximal(chat.positions(frame(spark, turns), block), block).collect()}
    assert got == kept(turns)


def test_rendering(spark):
    turns = [(1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", "a"), (2, 0, "user", "a"),
             (3, 0, None, None), (4, 0, "user", ""), (4, 700, "user", "z")]
    rows = chat.collapsed(frame(spark, turns)).collect()
    got = {(r.conv_id, r.part): (r.n_turns, r.text) for r in rows}
    assert got == {
        (1, 0): (
            2,
            "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb< |im_end|><|im_end|>",
        ),
        (3, 0): (1, "<|im_start|>\n<|im_end|>"),
        (4, 0): (2, "<|im_start|>user\n<|im_end|>\n<|im_start|>user\nz<|im_end|>"),
    }


def test_edge_cases(spark):
    turns = [(None, 0, "user", "a"), (1, None, "user", "first"), (1, 0, "user", "x"),
             (2, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, None, "x"),
             (5, 0, "user", "q" * 100000), (6, 1, "b", "2"), (6, 1, "a", "1")]
    rows = chat.collapsed(frame(spark, turns)).collect()
    by = {(r.conv_id, r.part): r for r in rows}
    # 3 begins 2, whose repeated row is a turn of its own; null is another role than user.
    assert set(by) == {(1, 0), (2, 0), (4, 0), (5, 0), (6, 0)}
    assert by[1, 0].n_turns == by[2, 0].n_turns == 2
    same = frame(spark, [(6, 1, "a", "1"), (6, 1, "b", "2")])
    assert chat.collapsed(same).first().text == by[6, 0].text
    assert chat.collapsed(frame(spark, turns).limit(0)).count() == 0


def test_a_null_is_not_an_empty_string(spark):
    turns = [(1, 0, "user", None), (2, 0, "user", ""), (3, 0, None, "user"), (4, 0, "", "user")]
    got = {r.conv_id for r in chat.maximal(chat.positions(frame(spark, turns))).collect()}
    assert got == {1, 2, 3, 4}


def ordered(turns):
    """conv_id -> pieces in order of turn, nulls first, then digest."""
    out = {}
    for conv, turn, role, text in turns:
        head = "-" if role is None else f"{len(role)}:{role}"
        said = "-" if text is None else f"t{text}"
        digest = hashlib.sha256((head + said).encode()).hexdigest()
        piece = f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>"
        out.setdefault(conv, []).append((turn is not None, turn or 0, digest, piece))
    return {conv: [p[3] for p in sorted(own)] for conv, own in out.items()}


@pytest.mark.parametrize("block", [4, 512])
def test_repeated_and_missing_turn_numbers(spark, block):
    rng = random.Random(block)
    long = 3 * block + 1
    turns = [(1, None, "u", f"{i}") for i in range(long)]
    turns += [(2, 7, "u", "same")] * long + [(2, 8, "a", "end"), (2, None, "a", "first")]
    turns += [(3, rng.choice([None, 0, 1, 5000]), "u", f"{i % 90}") for i in range(2 * long)]
    turns += [(4, *t[1:]) for t in turns if t[0] == 3] + [(4, 6000, "a", "more")]
    turns += [(5, *t[1:]) for t in turns if t[0] == 1]
    turns += [(6, 0, "u", "x"), (6, block, "a", "y"), (7, 0, "u", "x"), (8, None, "u", "z")]
    rng.shuffle(turns)
    rows = chat.collapsed(frame(spark, turns), block).collect()
    assert all(0 < r.n_turns <= block for r in rows)
    want = ordered(turns)
    assert {r.conv_id for r in rows} == {1, 2, 4, 6, 8}
    for conv in (1, 2, 4, 6, 8):
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.part)
        assert "\n".join(r.text for r in own) == "\n".join(want[conv])
        assert sum(r.n_turns for r in own) == len(want[conv])
        assert [r.part for r in own] == list(range(-(-len(want[conv]) // block)))
        assert all(r.n_turns == block for r in own[:-1])


def test_the_query_is_its_sql_on_repeated_and_missing_numbers(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(5)
    turns = [(1, 5, "u", f"t{i % 400}") for i in range(600)]
    turns += [(2, None, "u", f"t{i}") for i in range(1100)] + [(3, None, "u", "same")] * 700
    turns += [(4, rng.choice([None, 0, 0, 9]), rng.choice("ua"), rng.choice("xyz")) for _ in range(90)]
    turns += [(5, *t[1:]) for t in turns if t[0] == 1] + [(5, 6, "a", None), (None, 1, "u", "x")]
    frame(spark, turns).drop("pos", "digest").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op3_chat"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.SQL["op3_chat"])
    names = [c[0] for c in want.description]
    rows = want.fetchall()
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(rows)
    assert {r[names.index("conv_id")] for r in rows} == {2, 3, 4, 5}
