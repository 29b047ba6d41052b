"""Frontier state from a stream of fetch outcomes (K1, K4)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmament import fixed_values as fv
from firmament.operators.frontier import as_entries, combine_entries, entry_state

_ENTRY_SCHEMA = (
    "url string, event_id bigint, site_key string, done int, failures bigint, ts timestamp, batch_id bigint"
)


def batch_entries(outcomes: DataFrame) -> DataFrame:
    """Stored form of log rows: one combined entry per URL, and every failure on its own.

    Only failures are counted, so they keep their event ids; everything else is a
    minimum or maximum, which a repeated delivery does not change.
    """
    return _merged(as_entries(outcomes))


def _merged(entries: DataFrame) -> DataFrame:
    failed = entries.filter(F.col("failures") > 0).dropDuplicates(["url", "event_id"])
    return combine_entries(entries.filter(F.col("failures") == 0)).unionByName(failed)


def frontier_sink(folder: str):
    """``foreachBatch`` function that appends the entries of a batch.

    A batch writes only its own partition, so its cost follows the batch and not the
    frontier, and replaying it overwrites the same partition.  There is no watermark: a
    row counts however late it comes, and a failure counts once however often it comes.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch_entries(batch).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return append


def read_frontier(spark: SparkSession, folder: str, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """Current state: the stored entries of all batches combined."""
    try:
        entries = spark.read.schema(_ENTRY_SCHEMA).parquet(folder)
    except AnalysisException:
        entries = spark.createDataFrame([], _ENTRY_SCHEMA)
    return entry_state(combine_entries(_merged(entries.drop("batch_id"))), max_attempts)


def compact_frontier(spark: SparkSession, folder: str, target: str) -> None:
    """Write all batches of ``folder`` as one batch of a new folder."""
    entries = spark.read.schema(_ENTRY_SCHEMA).parquet(folder).drop("batch_id")
    _merged(entries).write.mode("errorifexists").parquet(f"{target}/batch_id=0")


def start_frontier(outcomes: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; run again for the next stretch."""
    return (
        outcomes.writeStream.foreachBatch(frontier_sink(folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_state(outcomes: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """The same fold as a streaming aggregate, for update or complete output, of a log without repeats."""
    return entry_state(combine_entries(as_entries(outcomes)), max_attempts)
