"""Wide registry reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.functions import normalize as N
from firmament.functions import registry as R
from firmament.operators.filters import filter_companies, sort_columns, take
from firmament.schemas import Master
from firmament.session import cut

SORT_FIELDS = [
    "name",
    "inn",
    "address",
    "director",
    "scrape_date",
    "first_seen_at",
    "last_seen_at",
    "status_official",
    "source_count",
]

REPORT_COLUMNS = [
    "name",
    "registry_status",
    "address",
    "address_official",
    "phones",
    "emails",
    "director",
    "director_official",
    "inn",
    "ogrn",
    "kpp",
    "legal_name",
    "legal_name_official",
    "registration_date",
    "official_verified_at",
    "scrape_date",
    "website",
    "sources",
]

# Column headers of the delivered report, in report order.
REPORT_HEADERS = [
    "Название",
    "Статус ФНС",
    "Адрес (агрегатор)",
    "Офиц. адрес (ЕГРЮЛ)",
    "Телефоны",
    "Email",
    "Директор (агрегатор)",
    "Офиц. руководитель (ЕГРЮЛ)",
    "ИНН",
    "ОГРН",
    "КПП",
    "Юр. название",
    "Офиц. наименование (ЕГРЮЛ)",
    "Дата регистрации",
    "Дата проверки ФНС",
    "Дата парсинга",
    "Сайт",
    "Источники",
]

CELL_VALUES = 10_000  # of one kind in one cell; the next part of the company goes on
_KINDS = ["phone", "email", "kpp", "source"]


def source_counts(master: Master) -> DataFrame:
    """Number of sources of every company, zero included."""
    counted = master.sources.groupBy("company_id").agg(F.count("*").alias("source_count"))
    return master.companies.select("company_id").join(counted, "company_id", "left").select(
        "company_id", F.coalesce("source_count", F.lit(0)).alias("source_count")
    )


def _child_values(master: Master) -> DataFrame:
    contacts = master.contacts.select("company_id", F.col("contact_type").alias("kind"), "first_seen_at", "value")
    kpp = master.kpp.select("company_id", F.lit("kpp").alias("kind"), F.lit("").alias("first_seen_at"), F.col("kpp").alias("value"))
    sources = master.sources.select(
        "company_id", F.lit("source").alias("kind"), "first_seen_at", F.col("source_url").alias("value")
    )
    return contacts.unionByName(kpp).unionByName(sources)


def _ranked(values: DataFrame) -> DataFrame:
    """Values with ``rank``, their place by first sight within a company and kind, from 0 on.

    Values are dealt into ranges of that order, so a company that owns most of them lies in many
    ranges; a value's rank is its place in its range and what earlier ranges hold of its group.
    """
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group, order = ["company_id", "kind"], ["first_seen_at", "value"]
    ranged = cut(values.repartitionByRange(parts, *group, *order).withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        ranged.groupBy(*group, "range").agg(F.count("*").alias("n"))
        .select(*group, "range", F.sum("n").over(before).alias("ahead")).filter("ahead > 0")
    )
    nth = F.row_number().over(Window.partitionBy(*group, "range").orderBy(*order))
    placed = ranged.withColumn("nth", nth).join(ahead, [*group, "range"], "left")
    return placed.withColumn("rank", F.col("nth") - 1 + F.coalesce("ahead", F.lit(0))).drop("range", "nth", "ahead")


def joined_children(values: DataFrame, cell_values: int = CELL_VALUES,
                    separators: dict[str, str] | None = None) -> DataFrame:
    """Phones, e-mails, kpp and sources of a company as joined text, by first sight.

    A cell holds ``cell_values`` values at most; those that follow stand in the next ``part`` of
    the company.  So the parts of any company, put one after another, are all values in order.
    """
    part = F.floor(F.col("rank") / cell_values).cast("int").alias("part")

    def cell(kind):
        own = F.collect_list(F.when(F.col("kind") == kind, F.struct("first_seen_at", "value")))
        text = F.array_join(F.array_sort(own)["value"], (separators or {}).get(kind, "\n"))
        return N.blank_to_null(text).alias(kind)

    return _ranked(values).groupBy("company_id", part).agg(*[cell(k) for k in _KINDS])


def _with_children(master: Master, companies: DataFrame, limit: int, cell_values: int,
                   separators: dict[str, str] | None = None) -> DataFrame:
    values = _child_values(master)
    if limit > 0:
        values = cut(values.join(companies.select("company_id"), "company_id", "left_semi"))
    cells = joined_children(values, cell_values, separators)
    return companies.join(cells, "company_id", "left").select(
        companies["*"],
        F.coalesce("part", F.lit(0)).alias("part"),
        F.col("phone").alias("phones"), F.col("email").alias("emails"),
        "kpp", F.col("source").alias("sources"),
    )


def registry_report(
    master: Master,
    sort_by: list[tuple[str, str]] = (("name", "ASC"),),
    limit: int = 0,
    cell_values: int = CELL_VALUES,
    **filters,
) -> DataFrame:
    """Eighteen report columns per company, plus company_id and part.

    A limited report picks and keeps its companies first, so only their children
    enter the aggregation.
    """
    chosen = filter_companies(master, **filters)
    if any(field == "source_count" for field, _ in sort_by):
        chosen = chosen.join(source_counts(master), "company_id")
    order = sort_columns(sort_by, SORT_FIELDS, "name")
    if limit > 0:
        chosen = cut(take(chosen.orderBy(*order, "company_id"), limit))
    rows = _with_children(master, chosen, limit, cell_values).withColumn(
        "registry_status", R.report_status("status_official", "liquidation_date", "inn")
    )
    return rows.orderBy(*order, "company_id", "part").select("company_id", "part", *REPORT_COLUMNS)


def companies_with_contacts(master: Master, cell_values: int = CELL_VALUES) -> DataFrame:
    """All companies with joined contacts, kpp separated by commas (R2)."""
    return (
        _with_children(master, master.companies, 0, cell_values, {"kpp": ", "})
        .orderBy(F.col("name").asc_nulls_last(), "company_id", "part")
        .select(
            "company_id", "part", "name", "status_aggregator", "status_official", "address", "phones",
            "emails", "director", "inn", "ogrn", F.col("kpp").alias("kpp_list"), "legal_name",
            "legal_name_official", "inn_verified", "registration_date", "website",
            "official_verified_at", "scrape_date", "first_seen_at", "last_seen_at", "sources",
        )
    )


def typed_report(report: DataFrame) -> DataFrame:
    """Report with real dates beside the raw text, label text and blank identifiers."""
    dates = ["registration_date", "official_verified_at", "scrape_date"]
    return report.withColumns(
        {
            **{f"{c}_parsed": N.parse_date(c) for c in dates},
            **{c: F.coalesce(c, F.lit("")) for c in ["inn", "ogrn", "kpp"]},
            "status_code": R.status_code("registry_status"),
            "status_label": R.status_label("registry_status"),
        }
    )


def with_headers(report: DataFrame) -> DataFrame:
    """Report under its delivered column headers."""
    return report.select(*[F.col(c).alias(h) for c, h in zip(REPORT_COLUMNS, REPORT_HEADERS)])
