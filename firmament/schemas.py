"""Table schemas, the master record group and the column contract."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_A = T.ArrayType(_S)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def _strings(*names):
    return [(n, _S, True) for n in names]


PAGES = _struct(
    ("page_id", _L, True),
    *_strings("url", "final_url", "site_key", "kind"),
    ("page_no", _I, True),
    ("content_type", _S, True),
    ("fetched_at", T.TimestampType(), True),
    ("html", _S, True),
)

IMMUTABLE = ["inn", "ogrn", "registration_date"]
FRESH = ["name", "legal_name", "director", "address"]
OFFICIAL = [
    "status_official",
    "inn_verified",
    "legal_name_official",
    "official_verified_at",
    "provider_name",
    "liquidation_date",
    "director_official",
    "address_official",
]

LISTINGS = _struct(
    ("source_url", _S, False),
    ("site_key", _S, True),
    *_strings(*IMMUTABLE, *FRESH, "website"),
    ("phones", _A, True),
    ("emails", _A, True),
    ("kpp_list", _A, True),
    *_strings("status_aggregator", "scrape_date", "last_seen_at"),
    ("ingest_seq", _L, False),
)

COMPANIES = _struct(
    ("company_id", _L, False),
    *_strings(*IMMUTABLE, *FRESH, "website"),
    ("status_aggregator", _S, False),
    *_strings(*OFFICIAL),
    ("first_seen_at", _S, False),
    ("last_seen_at", _S, False),
    ("scrape_date", _S, False),
)

SOURCES = _struct(
    ("company_id", _L, False),
    ("source_url", _S, False),
    ("site_key", _S, True),
    ("first_seen_at", _S, False),
    ("last_seen_at", _S, False),
)

CONTACTS = _struct(
    ("company_id", _L, False),
    ("contact_type", _S, False),
    ("value", _S, False),
    ("first_seen_at", _S, False),
    ("last_seen_at", _S, False),
)

KPP = _struct(("company_id", _L, False), ("kpp", _S, False), ("first_seen_at", _S, False))

FRONTIER = _struct(
    ("url", _S, False),
    ("site_key", _S, True),
    ("status", _S, False),
    ("attempts", _I, False),
    ("updated_at", T.TimestampType(), True),
)

OUTCOMES = _struct(
    ("url", _S, False),
    ("site_key", _S, True),
    ("event_id", _L, False),
    ("ts", T.TimestampType(), True),
    ("outcome", _S, False),
    ("response_sec", T.DoubleType(), True),
)

RESPONSES = _struct(
    ("provider", _S, False),
    ("inn", _S, False),
    ("fetched_at", T.TimestampType(), True),
    ("payload", _S, True),
)

RESULTS = _struct(
    ("inn", _S, False),
    ("status_official", _S, False),
    *_strings(
        "inn_verified",
        "legal_name_official",
        "liquidation_date",
        "director_official",
        "address_official",
        "verified_at",
    ),
    ("provider_name", _S, False),
)

# Scrape date of every fresh field of a company, which decides what a late record may overwrite.
DATES = _struct(("company_id", _L, False), *_strings(*[f"{c}_date" for c in FRESH]))

# Ids of companies that were merged away; no company gets them again.
RETIRED = _struct(("company_id", _L, False))

MASTER_TABLES = {"companies": COMPANIES, "sources": SOURCES, "contacts": CONTACTS, "kpp": KPP}
SIDE_TABLES = {"dates": DATES, "retired": RETIRED}

# Columns of an older layout that must not appear in ``companies``.
FORBIDDEN = {"source_url", "phones", "email", "kpp", "status"}


@dataclass(frozen=True)
class Master:
    """The four tables that make up the registry, and what later batches have to know.

    Without ``dates`` all fresh fields count as scraped when the company was seen last.  ``mark`` is
    the largest id given so far, ``version`` the stored version that this master comes from.
    """

    companies: DataFrame
    sources: DataFrame
    contacts: DataFrame
    kpp: DataFrame
    dates: DataFrame | None = None
    retired: DataFrame | None = None
    mark: int = 0
    version: int | None = None

    def with_tables(self, **tables: DataFrame) -> "Master":
        return replace(self, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MASTER_TABLES}

    def all_tables(self) -> dict[str, DataFrame]:
        """The four tables and the side tables there are."""
        return {n: getattr(self, n) for n in [*MASTER_TABLES, *SIDE_TABLES] if getattr(self, n) is not None}


def empty_master(spark: SparkSession) -> Master:
    return Master(**{n: spark.createDataFrame([], s) for n, s in {**MASTER_TABLES, **SIDE_TABLES}.items()})


def dated_companies(companies: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Companies with the scrape date of every fresh field beside it."""
    names = [f"{c}_date" for c in FRESH]
    if dates is None:
        return companies.withColumns({n: F.col("scrape_date") for n in names})
    joined = companies.join(dates, "company_id", "left")
    return joined.withColumns({n: F.coalesce(n, "scrape_date") for n in names})


def contract_diff(df: DataFrame, schema: T.StructType, forbidden: set[str] = frozenset()) -> list[str]:
    """Differences between a table and its declared schema; empty when it conforms."""
    actual = {f.name: f.dataType for f in df.schema}
    diff = [f"missing {f.name}" for f in schema if f.name not in actual]
    diff += [
        f"{f.name} is {actual[f.name].simpleString()}, not {f.dataType.simpleString()}"
        for f in schema
        if f.name in actual and actual[f.name] != f.dataType
    ]
    return diff + [f"forbidden {n}" for n in sorted(forbidden & actual.keys())]


def check_master(master: Master) -> Master:
    """Raise when a master table does not follow its contract."""
    problems = []
    schemas = {**MASTER_TABLES, **SIDE_TABLES}
    for name, table in master.all_tables().items():
        banned = FORBIDDEN if name == "companies" else frozenset()
        problems += [f"{name}: {d}" for d in contract_diff(table, schemas[name], banned)]
    if problems:
        raise ValueError("; ".join(problems))
    return master
