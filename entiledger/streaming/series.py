"""A load series as a stream of files: one file is one batch, in arrival order."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from entiledger.plans.jobs import LoadRejected, load

_LOG = logging.getLogger(__name__)


def stream_series(
    spark: SparkSession,
    database: str,
    table: str,
    folder: str,
    schema: T.StructType,
    row_no: str,
    state: str,
    fmt: str = "json",
) -> StreamingQuery:
    """Load every new file of a folder as its own batch, then stop.

    ``state`` is the stream's checkpoint folder; it keeps a restarted series from
    loading finished files again. A rejected file is skipped, like a rejected batch
    of a series. A file whose load was cut off is taken up again with the numbers that
    it had, under a ticket of the stream and the batch, so nothing is loaded twice.
    """

    def load_one(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        try:
            session, ticket = batch.sparkSession, f"{state}#{batch_id}"
            load(session, database, table, [batch], row_no, ticket)
        except LoadRejected as reason:
            _LOG.warning("file %s of the series skipped: %s", batch_id, reason)

    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .format(fmt)
        .load(folder)
    )
    return (
        files.writeStream.foreachBatch(load_one)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
