"""Cascade matching of records to known companies.

Every key a record can be found by becomes one narrow row ``(level, key)``; the
known companies are reduced to one row per ``(level, key)``.  One equi join and
one aggregation then answer all four levels at once, and the wide records never
enter the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.functions import normalize as N
from firmament.schemas import Master

INN, WEBSITE, SOURCE, NAME_PHONE = 1, 2, 3, 4
LEVELS = {"inn": INN, "website": WEBSITE, "source": SOURCE, "name_phone": NAME_PHONE}


def _entry(level: int, key):
    return F.struct(F.lit(level).alias("level"), key.alias("key"))


def name_phone_key(name, fingerprint):
    return F.concat_ws("\u001f", name, fingerprint)


def key_record(listings: DataFrame, unify_prefix: bool = False) -> DataFrame:
    """What identifies a record: ``(ingest_seq, inn, website, source_url, name_norm, fps)``, and its date.

    Columns that tell records of one number apart (``row_id``, ``tie``) come along where there are such.
    """
    return listings.select(
        *[c for c in ("row_id", "tie") if c in listings.columns], "ingest_seq", "inn", "website", "source_url", "scrape_date",
        F.when(F.col("name") != "", N.normalize_name("name")).alias("name_norm"),
        N.fingerprints("phones", unify_prefix).alias("fps"),
    )


def filled(entries):
    """Entries whose key is neither null nor empty."""
    return F.filter(entries, lambda e: F.coalesce(e["key"], F.lit("")) != "")


def soft_entries(name, fps):
    """Name-and-phone entries; none for a record without a name."""
    return F.transform(fps, lambda fp: _entry(NAME_PHONE, F.when(name.isNotNull(), name_phone_key(name, fp))))


def explode_keys(records: DataFrame, number: str = "ingest_seq") -> DataFrame:
    """``(ingest_seq, has_inn, level, key)`` rows of key records."""
    single = F.array(
        _entry(INN, F.col("inn")),
        _entry(WEBSITE, F.col("website")),
        _entry(SOURCE, F.col("source_url")),
    )
    keys = filled(F.concat(single, soft_entries(F.col("name_norm"), F.col("fps"))))
    return records.select(number, F.col("inn").isNotNull().alias("has_inn"), F.inline(keys))


def record_keys(listings: DataFrame, unify_prefix: bool = False) -> DataFrame:
    return explode_keys(key_record(listings, unify_prefix))


def phone_keys(master: Master, unify_prefix: bool = False) -> DataFrame:
    """Name-and-phone keys of the companies that have both (J6); optionally 8 and 7 are one prefix."""
    named = master.companies.filter(F.col("name").isNotNull()).select(
        "company_id", F.col("inn").isNotNull().alias("has_inn"), N.normalize_name("name").alias("name_norm")
    )
    phones = (
        master.contacts.filter(F.col("contact_type") == "phone")
        .select("company_id", N.phone_fingerprint("value", unify_prefix).alias("fp"))
        .filter(N.usable_fingerprint(F.col("fp")))
    )
    return phones.join(named, "company_id").select(
        "company_id", "has_inn", "name_norm", "fp",
        name_phone_key(F.col("name_norm"), F.col("fp")).alias("key"),
    )


def company_keys(master: Master, unify_prefix: bool = False) -> DataFrame:
    """``(company_id, has_inn, level, key)`` rows of the known companies."""
    own = F.array(_entry(INN, F.col("inn")), _entry(WEBSITE, F.col("website")))
    by_field = master.companies.select(
        "company_id",
        F.col("inn").isNotNull().alias("has_inn"),
        F.inline(filled(own)),
    )
    by_source = master.sources.select(
        "company_id", F.lit(None).cast("boolean").alias("has_inn"),
        F.lit(SOURCE).alias("level"), F.col("source_url").alias("key"),
    )
    by_phone = phone_keys(master, unify_prefix).select(
        "company_id", "has_inn", F.lit(NAME_PHONE).alias("level"), "key"
    )
    return by_field.unionByName(by_source).unionByName(by_phone)


def key_index(keys: DataFrame) -> DataFrame:
    """One row per key: lowest company, and lowest company without inn."""
    return keys.groupBy("level", "key").agg(
        F.min("company_id").alias("any_id"),
        F.min(F.when(~F.col("has_inn"), F.col("company_id"))).alias("open_id"),
    )


def candidates(listings: DataFrame, master: Master, levels: list[int] | None = None, unify_prefix: bool = False) -> DataFrame:
    """Company each level proposes: ``(ingest_seq, level, company_id)``.

    A record that carries an inn may only take a company without one on the
    name-and-phone level.
    """
    wanted = record_keys(listings, unify_prefix)
    known = company_keys(master, unify_prefix)
    if levels:
        wanted = wanted.filter(F.col("level").isin(levels))
        known = known.filter(F.col("level").isin(levels))
    proposal = F.when(
        (F.col("level") == NAME_PHONE) & F.col("has_inn"), F.col("open_id")
    ).otherwise(F.col("any_id"))
    return (
        wanted.join(key_index(known), ["level", "key"])
        .select("ingest_seq", "level", proposal.alias("company_id"))
        .filter(F.col("company_id").isNotNull())
        .groupBy("ingest_seq", "level")
        .agg(F.min("company_id").alias("company_id"))
    )


def match_batch(listings: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """First level that hits for every record; nulls when the company is new."""
    numbers = list(LEVELS.values())
    per_level = candidates(listings, master, unify_prefix=unify_prefix).groupBy("ingest_seq").agg(
        *[F.min(F.when(F.col("level") == n, F.col("company_id"))).alias(f"id_{n}") for n in numbers]
    )
    ids = [F.col(f"id_{n}") for n in numbers]
    best = per_level.select(
        "ingest_seq",
        F.coalesce(*[F.when(i.isNotNull(), F.lit(n)) for i, n in zip(ids, numbers)]).alias("matched_level"),
        F.coalesce(*ids).alias("company_id"),
    )
    return listings.select("ingest_seq").join(best, "ingest_seq", "left")
