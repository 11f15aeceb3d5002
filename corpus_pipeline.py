"""A corpus pipeline: quality, near duplicates, benchmarks, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, in the
columns of documents; the last returns their token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from entiledger.llm import bpe, decontaminate, pii, quality, simhash
from entiledger.llm.common import folder, read, spare

TOKENIZER = "byte_bpe_50k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labels, doesn't reject."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    name = spare(docs, "_quality")
    scored = quality.score(docs, model, into=name)
    return scored.where(quality.accepted(scored[name])).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    return simhash.survivors(docs, shingle=3, max_bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """All documents, personal data replaced by pseudonyms of equal length."""
    name = spare(docs, "_pii")
    return pii.pseudonymise(docs, into=name).drop(name)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, lossless): the token ids of each document.

    lossless tells whether decoding the ids gives the text again.
    """
    vocabulary = bpe.share(spark, public_tokenizers.path(TOKENIZER))
    coded = bpe.round_trip(docs, vocabulary)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", as_tokens),
]

#: SQL can't express the stages; the tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read by the next.

    Every run has a folder of its own beside the checkpoints, `stages-` and a number,
    with a folder for each stage, which stays.
    """
    place = f"{folder(spark)}/stages-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}.parquet")
        docs = read(spark, place, name)
    return STAGES[-1][1](spark, docs, sf_dir)
