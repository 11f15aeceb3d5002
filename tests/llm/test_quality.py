import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from entiledger.llm import quality, queries


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    got = queries.QUERIES["op5_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    right = [r.predicted == r.quality for r in rows]
    junk = [r.predicted == 0 for r in rows if r.quality == 0]
    good = [r.predicted == 1 for r in rows if r.quality == 1]
    assert np.mean(right) > 0.97
    assert np.mean(junk) > 0.9
    assert np.mean(good) > 0.97


def test_query_rows(spark, sf_dir, texts):
    rows = queries.QUERIES["op5_quality"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)


def test_held_out_labels_are_not_learnt(spark, docs_of):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = docs_of([(i, "some text") for i in range(60)])
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in ids] + [(None, 1, 0), (1, None, 0), (2, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    assert quality.sample(docs, labels).count() == 0
    model = quality.fit(docs, labels)
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}


def test_sample_is_bounded(spark, docs_of):
    docs = docs_of([(i % 40, f"text {i}") for i in range(120)])
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(40)] * 2, "doc_id long, quality int, toxic int"
    )
    counts = quality.sample(docs, labels, 5).groupBy("label").count().collect()
    assert {(r.label, r["count"]) for r in counts} == {(0, 5), (1, 5)}


def test_edge_cases(spark, docs_of):
    rng = np.random.default_rng(0)
    made = [" ".join("abcdefgh"[j] * 3 for j in rng.integers(0, 8, 30)) for _ in range(40)]
    pairs = [(i, t if i % 2 else t.upper() + "!!") for i, t in enumerate(made)]
    extra = [(100, None), (101, ""), (102, "x"), (103, "word " * 60000), (None, made[0]),
             (1, made[1]), (104, "\u0000"), (105, "日本")]
    docs = docs_of(pairs + extra)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int"
    )
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model)
    assert set(scored.columns) == {*docs.columns, "score"}
    rows = scored.collect()
    assert len(rows) == len(pairs) + len(extra)
    by = {r.text: r.score for r in rows}
    assert all(0 <= r.score <= 1 for r in rows)
    assert by[None] == by[""]
    assert by[made[1]] > 0.5 > by[pairs[0][1]]
    assert len({r.score for r in rows if r.text == made[1]}) == 1
    assert quality.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("size", [1, 7, 10**9])
def test_blocks_do_not_matter(monkeypatch, size):
    texts = ["One two two.", None, "", "EN EN EN!!", "é ü", "a" * 3000, "one | two | three"]
    whole = quality.terms(texts)
    monkeypatch.setattr(quality, "BLOCK", size)
    assert np.allclose(quality.terms(texts), whole)
    single = np.vstack([quality.terms([t]) for t in texts])
    assert np.allclose(single, whole)


def test_labels_and_ids_are_no_input(spark, docs_of):
    docs = docs_of([(i, f"text {i % 5} of " + "abc " * i) for i in range(30)])
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int"
    )
    model = quality.fit(docs, labels)
    other = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("z"))
    a = {r.text: r.score for r in quality.score(docs, model).collect()}
    b = {r.text: r.score for r in quality.score(other, model).collect()}
    assert a == b


def plain_score(model, text):
    """One text by itself: whole-number products, one labelled vector after the other."""
    terms = [round(float(x) * quality.UNITS) for x in quality.terms([text])[0]]
    columns = [[int(x) for x in c] for c in model.projection.T]
    latent = [sum(a * b for a, b in zip(terms, c, strict=True) if a) for c in columns]
    size = math.sqrt(math.fsum(float(x) ** 2 for x in latent)) or 1.0
    unit = [round(x / size * quality.FINE) for x in latent]
    near = [sum(a * int(b) for a, b in zip(unit, v, strict=True)) for v in model.vectors]
    last = sorted(near, reverse=True)[: quality.NEIGHBOURS][-1]
    votes = [(max(c / quality.FINE**2, 1e-6) ** quality.POWER, y)
             for c, y in zip(near, model.labels, strict=True) if c >= last]
    return math.fsum(w * y for w, y in votes) / math.fsum(w for w, _ in votes)


def test_the_query_against_a_plain_version(spark, sf_dir, texts):
    rows = queries.QUERIES["op5_quality"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    for r in rows:
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-9


def test_ties_of_the_last_neighbour_all_vote(spark, docs_of):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:60]
    docs = docs_of([(i, "the same text for all of them") for i in ids])
    for flip in (0, 1):
        labels = spark.createDataFrame(
            [(i, (n + flip) % 2, 0) for n, i in enumerate(ids)], "doc_id long, quality int, toxic int"
        )
        model = quality.fit(docs, labels)
        (score,) = {r.score for r in quality.score(docs, model).collect()}
        assert abs(score - 0.5) < 1e-9


def test_scores_do_not_depend_on_blocks(spark, sf_dir, texts, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    listed = [texts[i] for i in sorted(texts)]
    whole = quality.vote(model, listed).tolist()
    for size in (1, 7, 100):
        monkeypatch.setattr(quality, "ROWS", size)
        assert quality.vote(model, listed).tolist() == whole


def test_validation_uses_training_labels_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    choices = [(15, 24, 2.0), (1, 1, 1.0)]
    got = quality.validated(docs, labels, choices)
    assert all(0.5 < share <= 1 for share in got)
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality.validated(docs, flipped, choices) == got
