"""Child tables: insert-or-ignore and upsert as one aggregation per table.

Existing rows take part with arrival number -1, so "keep what is there" is the
minimum of the arrival order.  The aggregates combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.functions import normalize as N

def before_all():
    """Arrival number of what is already there; a function because columns need a session."""
    return F.lit(-1).cast("bigint")


def first_by(order: list, *values: str):
    """Struct of ``values`` from the first row in ``order``."""
    return F.min(F.struct(*order, *values))


def upsert_sources(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Key source_url: the company stays, only last_seen_at follows the newest arrival.

    ``incoming(company_id, source_url, site_key, seen_at, ingest_seq)``.
    """
    rows = existing.withColumn("seq", before_all()).unionByName(
        incoming.select(
            "company_id", "source_url", "site_key",
            F.col("seen_at").alias("first_seen_at"), F.col("seen_at").alias("last_seen_at"),
            F.col("ingest_seq").alias("seq"),
        )
    )
    return (
        rows.groupBy("source_url")
        .agg(
            first_by(["seq"], "company_id", "site_key", "first_seen_at").alias("f"),
            F.max(F.struct("seq", "last_seen_at")).alias("l"),
        )
        .select("f.company_id", "source_url", "f.site_key", "f.first_seen_at", "l.last_seen_at")
    )


def _contact_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing and new contacts with their identity: digits for phones, text for e-mails."""
    rows = existing.withColumns({"seq": before_all(), "pos": F.lit(0)}).unionByName(
        incoming.select(
            "company_id", "contact_type", "value",
            F.col("seen_at").alias("first_seen_at"), F.col("seen_at").alias("last_seen_at"),
            F.col("ingest_seq").alias("seq"), "pos",
        )
    )
    fp = N.digits("value")
    identity = F.when((F.col("contact_type") == "phone") & N.usable_fingerprint(fp), fp).otherwise(F.col("value"))
    usable = (F.col("contact_type") != "phone") | (F.col("seq") < 0) | N.usable_fingerprint(fp)
    return rows.filter(usable).withColumn("identity", identity)


def upsert_contacts(existing: DataFrame, incoming: DataFrame, refresh_emails: bool = True) -> DataFrame:
    """Phones by fingerprint, untouched when known; e-mails by text, last_seen_at refreshed.

    ``refresh_emails=False`` leaves known e-mails alone as well (website contacts).
    ``incoming(company_id, contact_type, value, pos, seen_at, ingest_seq)``.
    """
    refreshed = F.when(F.col("contact_type") == "email", F.col("l.last_seen_at")) if refresh_emails else F.lit(None)
    return (
        _contact_rows(existing, incoming)
        .groupBy("company_id", "contact_type", "identity")
        .agg(
            first_by(["seq", "pos"], "value", "first_seen_at", "last_seen_at").alias("f"),
            F.max(F.struct("seq", "last_seen_at")).alias("l"),
        )
        .select(
            "company_id", "contact_type", "f.value", "f.first_seen_at",
            F.coalesce(refreshed, F.col("f.last_seen_at")).alias("last_seen_at"),
        )
    )


def new_contacts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Contacts that are really inserted, one row each."""
    return (
        _contact_rows(existing, incoming)
        .groupBy("company_id", "contact_type", "identity")
        .agg(first_by(["seq", "pos"], "value", "first_seen_at", "last_seen_at").alias("f"))
        .filter(F.col("f.seq") >= 0)
        .select("company_id", "contact_type", "f.value", "f.first_seen_at", "f.last_seen_at")
    )


def new_contact_counts(inserted: DataFrame) -> DataFrame:
    """``(company_id, new_emails, new_phones)``."""
    return inserted.groupBy("company_id").agg(
        F.count_if(F.col("contact_type") == "email").alias("new_emails"),
        F.count_if(F.col("contact_type") == "phone").alias("new_phones"),
    )


def upsert_kpp(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-or-ignore on (company_id, kpp); ``incoming(company_id, kpp, seen_at, ingest_seq)``."""
    rows = existing.withColumn("seq", before_all()).unionByName(
        incoming.select("company_id", "kpp", F.col("seen_at").alias("first_seen_at"), F.col("ingest_seq").alias("seq"))
    )
    return (
        rows.groupBy("company_id", "kpp")
        .agg(first_by(["seq"], "first_seen_at").alias("f"))
        .select("company_id", "kpp", "f.first_seen_at")
    )


def listing_contacts(assigned: DataFrame) -> DataFrame:
    """Phones and e-mails of assigned records as rows."""
    phones = F.transform(
        F.col("phones"), lambda v, i: F.struct(F.lit("phone").alias("contact_type"), v.alias("value"), i.alias("pos"))
    )
    emails = F.transform(
        F.col("emails"), lambda v, i: F.struct(F.lit("email").alias("contact_type"), v.alias("value"), i.alias("pos"))
    )
    return assigned.select(
        "company_id", F.col("scrape_date").alias("seen_at"), "ingest_seq", F.inline(F.concat(phones, emails))
    )


def listing_kpp(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "company_id", F.col("scrape_date").alias("seen_at"), "ingest_seq", F.explode("kpp_list").alias("kpp")
    )


def listing_sources(assigned: DataFrame) -> DataFrame:
    return assigned.select(
        "company_id", "source_url", "site_key", F.col("scrape_date").alias("seen_at"), "ingest_seq"
    )
