"""Data-quality checks that must come out empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.schemas import Master

UNIQUE_KEYS = {
    "companies": [["company_id"], ["inn"]],
    "sources": [["source_url"]],
    "contacts": [["company_id", "contact_type", "value"]],
    "kpp": [["company_id", "kpp"]],
}


def duplicate_keys(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """``(check, key, rows)`` for every repeated non-null key."""
    complete = df
    for c in key:
        complete = complete.filter(F.col(c).isNotNull())
    return (
        complete.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .select(
            F.lit(f"{name} {', '.join(key)}").alias("check"),
            F.concat_ws(" | ", *[F.col(c).cast("string") for c in key]).alias("key"),
            "rows",
        )
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def uniqueness_violations(master: Master, frontier: DataFrame | None = None) -> DataFrame:
    """Repeated keys of all master tables, and of the frontier when given."""
    checks = [
        duplicate_keys(getattr(master, table), key, table)
        for table, keys in UNIQUE_KEYS.items()
        for key in keys
    ]
    if frontier is not None:
        checks.append(duplicate_keys(frontier, ["url"], "frontier"))
    return _union(checks)


def domain_violations(master: Master) -> DataFrame:
    """Rows whose coded or required columns hold an illegal value (D3)."""

    def failing(df, name, condition, id_column):
        return df.filter(condition).select(
            F.lit(name).alias("check"), F.col(id_column).cast("string").alias("key")
        )

    companies = master.companies
    return _union(
        [
            failing(
                master.contacts, "contact_type",
                F.col("contact_type").isNull() | ~F.col("contact_type").isin("phone", "email"), "company_id",
            ),
            failing(
                companies, "status_aggregator",
                F.col("status_aggregator").isNull() | ~F.col("status_aggregator").isin(fv.AGGREGATOR_STATUSES),
                "company_id",
            ),
            failing(
                companies, "status_official",
                F.col("status_official").isNotNull() & ~F.col("status_official").isin(fv.OFFICIAL_STATUSES),
                "company_id",
            ),
            failing(
                companies, "dates",
                F.col("first_seen_at").isNull() | F.col("last_seen_at").isNull() | F.col("scrape_date").isNull(),
                "company_id",
            ),
        ]
    )


def orphans(master: Master) -> DataFrame:
    """Child rows without a company, counted by table and id."""
    parts = [
        getattr(master, table)
        .join(master.companies.select("company_id"), "company_id", "left_anti")
        .groupBy("company_id").agg(F.count("*").alias("rows"))
        .select(F.lit(table).alias("check"), "company_id", "rows")
        for table in ["sources", "contacts", "kpp"]
    ]
    return _union(parts)
