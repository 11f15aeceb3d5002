"""The pipeline's stages against plain versions of them, each on its own input."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from entiledger.llm import bpe, quality
from entiledger.llm.common import folder
from tests.llm.test_decontaminate import brute
from tests.llm.test_pii import expected
from tests.llm.test_simhash import classes, fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What goes into each stage and what comes out of it, as rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, after
        docs = after
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(stages):
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == COLUMNS, name


def test_quality(spark, sf_dir, stages):
    before, after = stages["quality"]
    model = quality.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = before.collect()
    scores = quality.vote(model, [r.text for r in rows])
    want = {r.doc_id for r, s in zip(rows, scores, strict=True) if s >= 0.3}
    assert {r.doc_id for r in after.collect()} == want
    assert len(want) < len(rows)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    rows = pairs(before)
    marks = [fingerprint(t) for _, t in rows]
    want = [rows[i] for i in sorted(set(classes(marks)))]
    assert pairs(after) == want
    assert len(want) < len(rows)


def test_decontamination(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    items = [
        (r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    ]
    found = brute(pairs(before), items, 13)
    want = sorted(d for d, (n, hit, _) in found.items() if not (hit and 20 * hit >= n))
    assert pairs(after) == want
    assert len(want) < len(found)


def test_personal_data(stages):
    before, after = stages["personal_data"]
    assert pairs(after) == sorted((i, expected(t)[0]) for i, t in pairs(before))


def test_tokens(stages):
    import public_tokenizers

    before, after = stages["tokens"]
    texts = dict(pairs(before))
    vocabulary = bpe.load(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    rows = after.collect()
    assert len(rows) == len(texts)
    for r in rows:
        (ids,) = bpe.encode_texts(vocabulary, [texts[r.doc_id]])
        assert r.ids == ids.tolist() and r.n_tokens == len(ids) and r.lossless


def test_run_is_all_stages(spark, sf_dir, stages):
    got = {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {(r.doc_id, r.n_tokens) for r in stages["tokens"][1].collect()}


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_edge_cases(spark, sf_dir, place):
    _, stage = corpus_pipeline.STAGES[place]
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d", None, "s", 7),
            (3, "x y " * 30000, "en", "s", 120000), (3, "x y " * 30000, "en", "s", 120000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    extra = docs.selectExpr("*", "1 AS fp", "2 AS ids", "3 AS score")
    last = place == len(corpus_pipeline.STAGES) - 1
    for table, empty in ((docs, False), (extra, False), (docs.limit(0), True)):
        done = stage(spark, table, sf_dir)
        found = done.collect()
        assert last or done.columns == table.columns
        assert (not found) if empty else len(found) <= len(rows)


def test_run_writes_every_stage(spark, sf_dir, stages):
    shared = Path(re.sub("^file:/*", "/", folder(spark)))
    before = set(shared.glob("stages-*"))
    assert corpus_pipeline.run(spark, sf_dir).count() == stages["tokens"][1].count()
    (own,) = set(shared.glob("stages-*")) - before
    names = [name for name, _ in corpus_pipeline.STAGES[:-1]]
    assert {p.stem for p in own.iterdir()} == set(names)
    for name in names:
        written = spark.read.parquet(f"{own}/{name}.parquet")
        assert written.columns == COLUMNS
        assert pairs(written) == pairs(stages[name][1])
