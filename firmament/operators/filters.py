"""Optional conjunctive filters on companies."""

from __future__ import annotations

import functools
import logging
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmament.schemas import Master

log = logging.getLogger(__name__)


def all_of(*conditions: Column | None) -> Column:
    """Conjunction of the conditions that are set."""
    return functools.reduce(operator.and_, [c for c in conditions if c is not None], F.lit(True))


def contains_text(column: str, text: str) -> Column:
    """Case-insensitive containment; wildcard characters in ``text`` stand for themselves."""
    escaped = text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
    return F.col(column).ilike(f"%{escaped}%")


def recheck_due(as_of: Column, days: int) -> Column:
    """Never verified, or verified more than ``days`` days before ``as_of``."""
    verified = F.try_to_timestamp("official_verified_at")
    return F.col("official_verified_at").isNull() | (
        verified < F.timestamp_add("DAY", F.lit(-days), as_of)
    )


def filter_companies(
    master: Master,
    city: str | None = None,
    site_key: str | None = None,
    status_official: str | None = None,
    has_inn: bool = False,
    has_phone: bool = False,
    has_website: bool = False,
    without_email: bool = False,
) -> DataFrame:
    """Companies that pass every filter that is set."""
    kept = master.companies.filter(
        all_of(
            contains_text("address", city) if city else None,
            F.col("status_official") == status_official if status_official else None,
            F.col("inn").isNotNull() if has_inn else None,
            (F.col("website").isNotNull() & (F.col("website") != "")) if has_website else None,
        )
    )
    if site_key:
        on_site = master.sources.filter(F.col("site_key") == site_key).select("company_id")
        kept = kept.join(on_site, "company_id", "left_semi")
    if has_phone:
        phones = master.contacts.filter(F.col("contact_type") == "phone").select("company_id")
        kept = kept.join(phones, "company_id", "left_semi")
    if without_email:
        emails = master.contacts.filter(F.col("contact_type") == "email").select("company_id")
        kept = kept.join(emails, "company_id", "left_anti")
    return kept


def take(df: DataFrame, limit: int) -> DataFrame:
    """First ``limit`` rows; zero means no limit."""
    return df.limit(limit) if limit > 0 else df


def sort_columns(sort_by: list[tuple[str, str]], allowed: list[str], default: str) -> list[Column]:
    """Nulls-last sort columns; unknown fields are reported and skipped."""
    columns = []
    for field, direction in sort_by:
        if field not in allowed:
            log.warning("unknown sort field %r skipped", field)
            continue
        c = F.col(field)
        columns.append(c.desc_nulls_last() if direction.upper() == "DESC" else c.asc_nulls_last())
    return columns or [F.col(default).asc_nulls_last()]
