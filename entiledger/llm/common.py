"""Tables, checkpoints and row keys that the operators share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints, that of `spark.checkpoint.dir`.

    Only a local session that names none gets a folder of its own; on a cluster one that
    its machines share must be named.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        local = re.fullmatch(r"local(\[.*\])?", context.master)
        if named is None and not local:
            raise ValueError("spark.checkpoint.dir names no shared folder")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder, without lineage."""
    folder(df.sparkSession)
    return df.checkpoint()


def text_key(text: Column) -> Column:
    """Identity of a text beside a doc_id: two rows that agree in both are one document."""
    return F.coalesce(F.xxhash64(text, F.length(text)), F.lit(0))


def spare(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case: name itself if it is free."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
