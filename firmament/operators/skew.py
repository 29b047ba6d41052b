"""Grouping helpers that stay balanced when one group holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def dealt(df: DataFrame, rows: int, per_task: int, *by: str) -> DataFrame:
    """Deal rows that are costly to process: work for every core, and tasks that do not grow with the input.

    ``by`` names columns that tell rows apart; without them rows go round.  The number of partitions is
    asked for, so adaptive execution does not put small ones together by their bytes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-rows // per_task)), *by)


def salt(key: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(salts))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    spread_by: str, rank_name: str = "rank") -> DataFrame:
    """First ``k`` rows of every group.

    A hot group is cut to ``k`` rows inside each of its salted slices first, so the
    ranking over the whole group sees at most ``SALTS * k`` rows.
    """
    sliced = df.withColumn("_slice", salt(F.col(spread_by)))
    local = Window.partitionBy(*group, "_slice").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    kept = sliced.withColumn("_local", F.row_number().over(local)).filter(F.col("_local") <= k)
    return (
        kept.drop("_slice", "_local")
        .withColumn(rank_name, F.row_number().over(final))
        .filter(F.col(rank_name) <= k)
    )
