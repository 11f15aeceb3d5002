import base64
from collections import Counter

import pytest
from pyspark.sql import functions as F

from entiledger.llm import queries, tokens

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


def encoder(name):
    with open(public.path(f"{name}.tiktoken"), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=table, special_tokens={}
    )


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    first = {}
    for r in sorted(docs, key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r.doc_id)
    want = Counter()
    for name in queries.VERSIONS:
        code = encoder(name)
        for r in docs:
            if first[r.text or ""] == r.doc_id:
                want[r.source, r.lang, name, "docs"] += 1
                want[r.source, r.lang, name, "tokens"] += len(code.encode_ordinary(r.text or ""))
    got = Counter()
    for r in queries.QUERIES["op8_token_counts"](spark, sf_dir).collect():
        got[r.source, r.lang, r.version, "docs"] += r.n_docs
        got[r.source, r.lang, r.version, "tokens"] += r.n_tokens
    assert +got == +want


def test_query_with_null_and_repeated_ids(spark, tmp_path):
    made = [
        (2, "one two", "b"), (2, "one two", "a"), (None, "one two", "a"), (3, "one two", "a"),
        (None, "only", "c"), (None, "only", "c"), (4, None, "d"), (4, "", "d"), (4, "x", "d"),
    ]
    columns = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame([(i, t, s, None, None) for i, t, s in made], columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op8_token_counts"](spark, str(tmp_path)).collect()
    for name in queries.VERSIONS:
        n = {t: len(encoder(name).encode_ordinary(t)) for t in ("one two", "only", "x")}
        got = {r.source: (r.n_docs, r.n_tokens) for r in found if r.version == name}
        assert got == {"a": (1, n["one two"]), "c": (1, n["only"]), "d": (2, n["x"])}


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", "en", 5), (2, "a", None, 7), (3, None, "en", None), (3, None, "en", 2)],
        "doc_id long, source string, lang string, n long",
    )


def totals(rollup):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_deltas(spark, rows):
    rollup = tokens.scratch(spark)
    assert rollup.batches() == [] and totals(rollup) == {}
    insert = tokens.changes(rows, "v1", 1, F.col("n"))
    assert rollup.commit("b1", insert)
    start = {("a", "en", "v1"): (1, 5), ("a", None, "v1"): (1, 7), (None, "en", "v1"): (2, 2)}
    assert totals(rollup) == start
    assert not rollup.commit("b1", insert.union(insert))
    assert totals(rollup) == start
    revised = tokens.revisions(rows.where("doc_id = 1"), "v1", F.col("n"), F.lit(9))
    assert rollup.commit("b2", revised)
    assert totals(rollup)["a", "en", "v1"] == (1, 9)
    gone = tokens.changes(rows.where("doc_id = 2"), "v1", -1, F.col("n"))
    assert rollup.commit("b3", gone) and not rollup.commit("b3", gone)
    assert totals(rollup) == {("a", "en", "v1"): (1, 9), (None, "en", "v1"): (2, 2)}
    assert rollup.commit("b4", insert.limit(0))
    assert rollup.batches() == ["b1", "b2", "b3", "b4"]
    rollup.drop()
    assert rollup.batches() == []


def test_a_write_that_was_cut_off_is_replaced(spark, rows):
    rollup = tokens.scratch(spark)
    insert = tokens.changes(rows, "v1", 1, F.col("n"))
    rollup.commit("b1", insert)
    files, mark = rollup._at("b1", "_SUCCESS")
    files.delete(mark, False)
    assert rollup.batches() == [] and totals(rollup) == {}
    assert rollup.commit("b1", insert)
    assert totals(rollup)["a", "en", "v1"] == (1, 5)
    rollup.drop()


def test_counts(spark, docs_of):
    name = queries.VERSIONS[0]
    docs = docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "<|endoftext|>"),
                    (4, "long " * 50000)])
    files = {name: public.path(f"{name}.tiktoken")}
    counted = tokens.counted(docs, files, public.PATTERN)
    assert set(counted.columns) == {*docs.columns, "n_tokens"}
    code = encoder(name)
    rows = counted.collect()
    assert len(rows) == 6
    assert all(r.n_tokens == {name: len(code.encode_ordinary(r.text or ""))} for r in rows)
    assert tokens.counted(docs.limit(0), files, public.PATTERN).count() == 0
