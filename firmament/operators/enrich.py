"""Registry enrichment: candidates, quotas, payloads, provider chain, update."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions import normalize as N
from firmament.functions import registry as R
from firmament.operators.children import new_contacts
from firmament.operators.filters import filter_companies, recheck_due, take
from firmament.operators.skew import top_k_per_group
from firmament.schemas import OFFICIAL, RESULTS, Master
from firmament.session import cut
from firmament.sources.snapshots import fresh_responses

NESTED_PAYLOAD = (
    "suggestions array<struct<data struct<inn string,"
    " name struct<full_with_opf string, short_with_opf string>,"
    " management struct<name string>, address struct<value string>,"
    " state struct<status string, liquidation_date bigint>>>>"
)
ROW_PAYLOAD = "rows array<struct<i string, n string, g string, e string>>"


@dataclass(frozen=True)
class Provider:
    """A registry source: lower priority numbers are asked first, no limit means unlimited."""

    key: str
    priority: int
    payload: str
    daily_limit: int | None = None
    enabled: bool = True
    label: str | None = None


# The known registry sources and their display names.
PROVIDERS = [
    Provider("A", 1, "nested", daily_limit=10_000, label="DaData ЕГРЮЛ"),
    Provider("B", 2, "rows", label="ФНС ЕГРЮЛ (egrul.nalog.ru)"),
]


def priority_order() -> list[Column]:
    """Never verified first, then not working, then the oldest verification (O2)."""
    return [
        F.col("status_official").isNull().desc(),
        (F.col("status_aggregator") != fv.AGGREGATOR_ACTIVE).desc(),
        F.col("official_verified_at").asc_nulls_first(),
        F.col("company_id"),
    ]


def due_companies(master: Master, as_of: Column, recheck_days: int = fv.RECHECK_DAYS,
                  city: str | None = None, site_key: str | None = None) -> DataFrame:
    return filter_companies(master, city=city, site_key=site_key, has_inn=True).filter(
        recheck_due(as_of, recheck_days)
    )


def enrich_candidates(master: Master, as_of: Column, limit: int = 0, **options) -> DataFrame:
    """``(company_id, inn)`` of companies that need a registry check, by priority."""
    due = due_companies(master, as_of, **options).orderBy(*priority_order())
    return take(due.select("company_id", "inn"), limit)


def assign_quota(requests: DataFrame, providers: list[Provider] = PROVIDERS) -> DataFrame:
    """Provider of every request: the first with room on that day.

    ``requests(inn, day, rank columns of priority_order)``.  A daily limit bounds the
    rows a provider takes, the rest flows to the next one; without room the provider
    is null.
    """
    remaining, parts = cut(requests), []
    for p in sorted((p for p in providers if p.enabled), key=lambda p: p.priority):
        if p.daily_limit is None:
            parts.append(remaining.select("inn", "day", F.lit(p.key).alias("provider")))
            remaining = None
            break
        taken = cut(
            top_k_per_group(remaining, ["day"], priority_order(), p.daily_limit, spread_by="inn").select("inn", "day")
        )
        parts.append(taken.withColumn("provider", F.lit(p.key)))
        remaining = remaining.join(taken, ["inn", "day"], "left_anti")
    if remaining is not None:
        parts.append(remaining.select("inn", "day", F.lit(None).cast("string").alias("provider")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _result(inn: Column, verified: Column, provider: Column, **fields: Column) -> list[Column]:
    values = {
        "inn": inn,
        "verified_at": F.date_format(verified, "yyyy-MM-dd HH:mm:ss"),
        "provider_name": provider,
        **fields,
    }
    return [
        (N.strip(values[n]) if n in fields else values[n]).alias(n) if n in values
        else F.lit(None).cast("string").alias(n)
        for n in RESULTS.names
    ]


def parse_nested(responses: DataFrame) -> DataFrame:
    """Results from payloads with a list of suggestions; an empty list gives no row."""
    first = F.get(F.from_json("payload", NESTED_PAYLOAD)["suggestions"], F.lit(0))
    d = F.col("first.data")
    return (
        responses.withColumn("first", first)
        .filter(F.col("first").isNotNull())
        .select(
            *_result(
                F.col("inn"), F.col("fetched_at"), F.col("provider"),
                status_official=R.map_provider_status(d["state"]["status"]),
                inn_verified=N.clean_numeric(d["inn"]),
                legal_name_official=R.legal_name(d["name"]["full_with_opf"], d["name"]["short_with_opf"]),
                liquidation_date=R.epoch_ms_to_date(d["state"]["liquidation_date"]),
                director_official=d["management"]["name"],
                address_official=d["address"]["value"],
            )
        )
    )


def parse_rows(responses: DataFrame) -> DataFrame:
    """Results from payloads with short-keyed rows; they carry no address."""
    first = F.get(F.from_json("payload", ROW_PAYLOAD)["rows"], F.lit(0))
    r = F.col("first")
    return (
        responses.withColumn("first", first)
        .filter(r.isNotNull())
        .select(
            *_result(
                F.col("inn"), F.col("fetched_at"), F.col("provider"),
                status_official=R.infer_status(r["e"], r["g"]),
                inn_verified=N.clean_numeric(r["i"]),
                legal_name_official=r["n"],
                director_official=R.director_name(r["g"]),
                liquidation_date=N.dotted_to_iso(N.blank_to_null(r["e"])),
            )
        )
    )


PAYLOADS = {"nested": parse_nested, "rows": parse_rows}


def provider_results(responses: DataFrame, providers: list[Provider] = PROVIDERS) -> DataFrame:
    """Parsed answers of all enabled providers with their priority."""
    parts = [
        PAYLOADS[p.payload](responses.filter(F.col("provider") == p.key))
        .withColumn("priority", F.lit(p.priority))
        .withColumn("provider_name", F.lit(p.label or p.key))
        for p in providers
        if p.enabled
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def provider_chain(results: DataFrame) -> DataFrame:
    """Answer of the first provider that has one for an inn, its newest if there are several."""
    rest = [c for c in RESULTS.names if c != "inn"]
    first = F.struct((-F.col("priority")).alias("early"), F.col("verified_at").alias("newest"), *rest)
    return (
        results.groupBy("inn")
        .agg(F.max(first).alias("r"))
        .select("inn", *[F.col(f"r.{c}") for c in rest])
    )


def results_by_company(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Results of the requested companies; companies without inn drop out."""
    return candidates.select("company_id", "inn").join(results, "inn")


def update_official(companies: DataFrame, results: DataFrame) -> DataFrame:
    """Overwrite the eight official columns where a result exists, nulls included.

    ``results(company_id, ...)`` holds one row per company.
    """
    new = results.select(
        "company_id", F.lit(True).alias("_hit"),
        *[F.col("verified_at" if c == "official_verified_at" else c).alias(f"_{c}") for c in OFFICIAL],
    )
    return companies.join(new, "company_id", "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in OFFICIAL else F.col(c)
            for c in companies.columns
        ]
    )


def enrichment_totals(requested: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """One row: requested, answered, of these probably cached and fresh."""
    age = F.unix_timestamp(as_of) - F.unix_timestamp(F.try_to_timestamp("verified_at"))
    joined = requested.select("inn").join(results.select("inn", "verified_at"), "inn", "left")
    return joined.agg(
        F.count("*").alias("requested"),
        F.count("verified_at").alias("answered"),
        F.count_if(age > fv.CACHED_AFTER_SECONDS).alias("cached"),
        F.count_if(F.col("verified_at").isNotNull() & ~F.coalesce(age > fv.CACHED_AFTER_SECONDS, F.lit(False))).alias("fresh"),
    )


def enrich_master(master: Master, responses: DataFrame, as_of: Column, limit: int = 0,
                  providers: list[Provider] = PROVIDERS, ttl_days: int = fv.RESPONSE_TTL_DAYS, **options) -> Master:
    """Candidates, newest fresh answers, provider chain and update in one job.

    Of a provider's answers for an inn the newest counts, and only while it is no older
    than ``ttl_days`` (0: any age).
    """
    wanted = enrich_candidates(master, as_of, limit, **options)
    answers = provider_chain(provider_results(fresh_responses(responses, as_of, ttl_days), providers))
    return master.with_tables(companies=update_official(master.companies, results_by_company(wanted, answers)))


def scan_candidates(master: Master, limit: int = 0, without_email: bool = True, **filters) -> DataFrame:
    """``(company_id, website)`` of companies whose site is to be scanned."""
    chosen = filter_companies(master, has_website=True, without_email=without_email, **filters)
    return take(chosen.orderBy("company_id").select("company_id", "website"), limit)


def found_contacts(found: DataFrame, seen_at: Column) -> DataFrame:
    """Scan results in the shape the contact upsert takes; ties break by value."""
    return found.select(
        "company_id", "contact_type",
        F.when(F.col("contact_type") == "email", F.lower(N.strip("value"))).otherwise(F.col("value")).alias("value"),
        F.lit(0).cast("bigint").alias("ingest_seq"), F.lit(0).alias("pos"), seen_at.alias("seen_at"),
    ).filter(F.col("value") != "")


def add_site_contacts(master: Master, found: DataFrame, seen_at: Column) -> tuple[Master, DataFrame]:
    """Master with the new website contacts, and the contacts that were new."""
    inserted = new_contacts(master.contacts, found_contacts(found, seen_at))
    return master.with_tables(contacts=master.contacts.unionByName(inserted)), inserted


def provider_table(spark: SparkSession, providers: list[Provider] = PROVIDERS) -> DataFrame:
    """The provider list as a small table for reports and joins."""
    return spark.createDataFrame(
        [(p.key, p.priority, p.daily_limit, p.enabled, p.label or p.key) for p in providers],
        "provider string, priority int, daily_limit int, enabled boolean, provider_name string",
    )
