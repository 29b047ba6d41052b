"""Incremental card upsert: each micro-batch becomes one delta of the master (K2, K3, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from firmament.operators.records import normalize_listings
from firmament.operators.upsert import upsert_changes
from firmament.sources.registry import RegistryStore


def upsert_sink(store: RegistryStore, writer: str):
    """``foreachBatch`` function; a batch that ``writer`` has already committed changes nothing.

    Batch ids count from 0 in every stream, so the writer's name belongs to the commit: no
    other stream and no batch job can make a batch look committed.

    Late records need no watermark: the stored date of every field decides what they may
    overwrite, so the result does not depend on where one batch ends and the next begins.
    A batch writes the companies it touches; if another writer commits first, it is resolved anew.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        listings = normalize_listings(batch)
        store.update(lambda master: upsert_changes(listings, master), batch_id, writer)

    return apply


def start_upsert(listings: DataFrame, store: RegistryStore, checkpoint: str) -> StreamingQuery:
    """Merge what has arrived into the store and stop; the checkpoint names the writer."""
    return (
        listings.writeStream.foreachBatch(upsert_sink(store, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
