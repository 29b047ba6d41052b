"""Frontier rows from a stream of landed listing pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmament.operators.extract import page_card_links
from firmament.plans.phases import frontier_rows
from firmament.sources.snapshots import latest_by

_LINKED_SCHEMA = "site_key string, page_no int, fetched_at timestamp, page_id bigint, links array<string>, batch_id bigint"


def discovery_sink(folder: str, rules: DataFrame):
    """``foreachBatch`` function that appends the link sets of the pages of a batch.

    Pages are parsed once, here; what is stored is their links.  A batch writes its own
    partition, so its cost follows the batch, and a replay overwrites the same partition.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        linked = page_card_links(batch, rules, "fetched_at", "page_id")
        linked = linked.withColumns({"page_no": F.col("page_no").cast("int"), "page_id": F.col("page_id").cast("bigint")})
        linked.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return append


def read_page_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of the newest copy of every listing page that has arrived."""
    try:
        linked = spark.read.schema(_LINKED_SCHEMA).parquet(folder)
    except AnalysisException:
        linked = spark.createDataFrame([], _LINKED_SCHEMA)
    newest = latest_by(linked.drop("batch_id"), ["site_key", "page_no"], ["fetched_at", "page_id"])
    return newest.select("site_key", "page_no", "links")


def read_discovered(spark: SparkSession, folder: str, known: DataFrame) -> DataFrame:
    """New frontier rows out of all pages so far; ``known`` addresses stay out.

    Where a catalogue ends depends on all its lower pages, and these may arrive later or
    be fetched again.  The end is therefore decided on what is stored, when it is asked
    for: any order of arrival and any split into batches gives the rows of the batch job.
    """
    return frontier_rows(read_page_links(spark, folder), known)


def start_discovery(pages: DataFrame, rules: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Take in the pages that have arrived and stop; run again for the next stretch."""
    return (
        pages.writeStream.foreachBatch(discovery_sink(folder, rules))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
