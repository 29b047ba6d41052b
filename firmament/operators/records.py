"""Company records: the repairs every incoming card goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions import normalize as N


def normalize_listings(listings: DataFrame) -> DataFrame:
    """Repair identifiers, website and list fields; bad values become null, no row is lost."""
    return listings.withColumns(
        {
            "inn": N.clean_inn("inn"),
            "ogrn": N.clean_ogrn("ogrn"),
            "website": N.normalize_website("website"),
            "phones": N.dedup_phones("phones"),
            "emails": N.dedup_emails("emails"),
            "kpp_list": N.clean_kpp_list("kpp_list"),
            "status_aggregator": F.coalesce("status_aggregator", F.lit(fv.AGGREGATOR_ACTIVE)),
            "last_seen_at": N.last_seen("last_seen_at", "scrape_date"),
            **{c: N.strip(c) for c in ["source_url", "registration_date", "name", "legal_name", "director", "address"]},
        }
    )


def website_groups(companies: DataFrame) -> DataFrame:
    """Websites that more than one company carries (G1)."""
    return (
        companies.filter(F.col("website").isNotNull())
        .groupBy("website")
        .agg(F.count("*").alias("companies"), F.min("company_id").alias("lowest_id"))
        .filter(F.col("companies") > 1)
    )
