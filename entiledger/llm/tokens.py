"""Token counts kept up by deltas.

Totals by source, language and tokenizer version are sums over signed changes: an insert
adds a document and its tokens, a delete takes them back, and a revised count is a delete
of the old count and an insert of the new one. A batch of changes is summed and stored
under its id, once: a batch whose write was completed is not written again, and one whose
write was cut off is replaced. So a replay changes nothing.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiledger.llm.common import folder, spare

KEYS = ["source", "lang", "version"]
CHANGE = ["doc_id", *KEYS, "sign", "n_tokens"]
SUMS = "source string, lang string, version string, n_docs long, n_tokens long"


def ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a vocabulary file, a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def counted(
    docs: DataFrame, versions: dict[str, str], pattern: str, text: str = "text"
) -> DataFrame:
    """docs with a map of token counts by version.

    versions: vocabulary files by version, which only the driver reads. Every whole text
    is counted by itself; a null or empty one has no tokens. The column is `n_tokens`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        {version: ranks(path) for version, path in versions.items()}
    )
    fields = ", ".join(f"v{i} long" for i in range(len(versions)))

    @F.pandas_udf(fields)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = [
            tiktoken.Encoding(
                name, pat_str=pattern, mergeable_ranks=table, special_tokens={}
            )
            for name, table in shared.value.items()
        ]
        for texts in batches:
            whole = [t or "" for t in texts]
            yield pd.DataFrame(
                {
                    f"v{i}": [len(e.encode_ordinary(t)) for t in whole]
                    for i, e in enumerate(encoders)
                }
            )

    inner = spare(docs, "_counts")
    counts = [
        x
        for i, version in enumerate(versions)
        for x in (F.lit(version), F.col(inner).getField(f"v{i}"))
    ]
    kept = [c for c in docs.columns if c != "n_tokens"]
    return docs.select(*kept, of(F.col(text)).alias(inner)).select(
        *kept, F.create_map(*counts).alias("n_tokens")
    )


def changes(rows: DataFrame, version: str, sign: int, n_tokens: Column) -> DataFrame:
    """One signed change for each row, inserts with sign 1 and deletes with sign -1.

    A null count adds no tokens, but its document counts.
    """
    return rows.select(
        "doc_id",
        "source",
        "lang",
        F.lit(version).alias("version"),
        F.lit(sign).alias("sign"),
        F.coalesce(n_tokens, F.lit(0)).cast("long").alias("n_tokens"),
    )


def revisions(rows: DataFrame, version: str, old: Column, new: Column) -> DataFrame:
    """Changes that replace the old count of each row by a new one."""
    return changes(rows, version, -1, old).union(changes(rows, version, 1, new))


def summed(deltas: DataFrame) -> DataFrame:
    """Sums of deltas by source, language and version; null keys are a group each."""
    return deltas.groupBy(*KEYS).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )


class Rollup:
    """Totals in a folder of committed batches, which all executors can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return place.getFileSystem(conf), place

    def committed(self, batch: str) -> bool:
        """Whether a batch was written to its end."""
        files, place = self._at(batch, "_SUCCESS")
        return files.exists(place)

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Store the sums of a batch of changes; False if that was done before.

        Sums are taken map-side first, so a hot source costs a row for each task.
        """
        if self.committed(batch):
            return False
        deltas = rows.select(
            *KEYS,
            F.col("sign").cast("long").alias("n_docs"),
            (F.col("sign") * F.col("n_tokens")).alias("n_tokens"),
        )
        summed(deltas).write.mode("overwrite").parquet(f"{self.path}/{batch}")
        return True

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        files, place = self._at()
        if not files.exists(place):
            return []
        names = [s.getPath().getName() for s in files.listStatus(place)]
        return sorted(n for n in names if self.committed(n))

    def totals(self) -> DataFrame:
        """Sums over all committed batches; groups without documents are left out."""
        paths = [f"{self.path}/{b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], SUMS)
        deltas = self.spark.read.schema(SUMS).parquet(*paths)
        return summed(deltas).where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def drop(self) -> None:
        """Remove the folder."""
        files, place = self._at()
        files.delete(place, True)


def scratch(spark: SparkSession) -> Rollup:
    """A rollup in a new folder beside the checkpoints."""
    return Rollup(spark, f"{folder(spark)}/token-rollup-{uuid.uuid4().hex}")
