"""Append-only page and response tables read as caches with a time to live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.urls import url_key
from firmament.schemas import PAGES, RESPONSES

def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PAGES).parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSES).parquet(path)


def append_pages(pages: DataFrame, path: str) -> None:
    pages.write.mode("append").parquet(path)


def append_responses(responses: DataFrame, path: str) -> None:
    """Store answers that carry a payload, one folder per provider."""
    responses.filter(F.col("payload").isNotNull()).write.mode("append").partitionBy("provider").parquet(path)


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key by partial maxima, so a key with many copies is thinned on the map side."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_n"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_n.{c}") for c in df.columns])


def fresh_only(df: DataFrame, as_of: Column, ttl_days: int) -> DataFrame:
    """Rows not older than the time to live; zero never expires.

    A plain comparison with a constant, which reaches the Parquet scan.
    """
    return df.filter(F.col("fetched_at") >= F.timestamp_add("DAY", F.lit(-ttl_days), as_of)) if ttl_days > 0 else df


def latest_snapshots(pages: DataFrame, as_of: Column, ttl_days: int = fv.PAGE_TTL_DAYS) -> DataFrame:
    """Newest copy of every URL, when it is still fresh (A2).

    Stale rows go before the newest is looked for: when the newest is stale, all are.
    The newest is found on narrow columns, so HTML moves once, and only if the optimizer
    cannot broadcast the keys.  A page_id names one copy.
    """
    fresh = fresh_only(pages, as_of, ttl_days)
    newest = fresh.groupBy(F.col("url").alias("u")).agg(F.max(F.struct("fetched_at", "page_id")).alias("n"))
    same = (
        F.col("url").eqNullSafe(F.col("u")) & F.col("fetched_at").eqNullSafe(F.col("n.fetched_at"))
        & F.col("page_id").eqNullSafe(F.col("n.page_id"))
    )
    return fresh.join(newest, same, "left_semi")


def snapshot_history(pages: DataFrame) -> DataFrame:
    """Dated copies an overwrite leaves behind: one per URL and day, newest excluded (A3)."""
    narrow = pages.select("url", "fetched_at", "page_id")
    newest = narrow.groupBy("url").agg(F.max(F.struct("fetched_at", "page_id")).alias("n"))
    older = narrow.join(newest.select("url", "n.*"), ["url", "fetched_at", "page_id"], "left_anti")
    return (
        older.withColumn("day", F.date_format("fetched_at", "yyyy-MM-dd"))
        .groupBy("url", "day")
        .agg(F.max(F.struct("fetched_at", "page_id")).alias("n"))
        .select(
            "url", F.concat_ws("_", url_key("url"), F.col("day")).alias("snapshot_name"),
            "n.fetched_at", "n.page_id",
        )
    )


def fresh_responses(responses: DataFrame, as_of: Column, ttl_days: int = fv.RESPONSE_TTL_DAYS) -> DataFrame:
    """Newest answer of every provider for an inn, when it is still fresh (A5)."""
    return latest_by(fresh_only(responses, as_of, ttl_days), ["provider", "inn"], ["fetched_at"])
