"""Site dimension and link rules (A10).

The tables are built from a Python list, so their size is the size of the
configuration and they are safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITE_SCHEMA = "site_key string, base_url string, rule_key string, page_pattern string"
RULE_SCHEMA = (
    "rule_key string, origin string, link_class string, path_pattern string,"
    " skip_slugs array<string>, card_prefix string"
)

DEFAULT_PAGE_PATTERN = "{base_url}page/{page}/"
QUERY_PAGE_PATTERN = "{base_url}?page={page}"

# Known sites and where their catalogues start.
SITES = [
    ("chop.moscow", "https://chop.moscow/catalog/", "site_a", DEFAULT_PAGE_PATTERN),
    ("prochop.ru", "https://prochop.ru/chops/", "site_b", DEFAULT_PAGE_PATTERN),
    ("vsechopy-mo", "https://xn--b1ag1aeh1b4a.xn--p1ai/region/moskovskaya-oblast/", "site_d", QUERY_PAGE_PATTERN),
    ("vsechopy-urfo", "https://xn--b1ag1aeh1b4a.xn--p1ai/region/sverdlovskaya-oblast/", "site_d", QUERY_PAGE_PATTERN),
    (
        "russkiisoyuz",
        "https://xn--g1abdcwihado2k.xn--p1ai/russia/services/okhrannye_predpriiatiia__detektivy/",
        "site_c",
        QUERY_PAGE_PATTERN,
    ),
]

# Which links of a listing page lead to company cards.
LINK_RULES = [
    ("site_a", "https://chop.moscow", None, "^/catalog/([^/]+)/?$",
     ["page", "add", "search", "category", "filter"], "/catalog/"),
    ("site_b", "https://prochop.ru", None, "^/chops/([^/]+)/?$",
     ["page", "add", "search", "category", "filter", "tag"], "/chops/"),
    ("site_c", "https://xn--g1abdcwihado2k.xn--p1ai", "title", "/services/", [], None),
    ("site_d", "https://xn--b1ag1aeh1b4a.xn--p1ai", None, "^/chop/([^/]+)/?$",
     ["page", "add", "search", "category", "filter", "city"], "/chop/"),
]


def site_table(spark: SparkSession, sites: list[tuple] = SITES) -> DataFrame:
    return spark.createDataFrame(sites, SITE_SCHEMA)


def link_rules(spark: SparkSession, sites: list[tuple] = SITES, rules: list[tuple] = LINK_RULES) -> DataFrame:
    """One rule row per site key."""
    return site_table(spark, sites).select("site_key", "rule_key").join(
        spark.createDataFrame(rules, RULE_SCHEMA), "rule_key"
    )


def catalog_page_url(base_url, page_pattern, page):
    """Address of a catalogue page; page one is the base itself."""
    base = F.when(base_url.endswith("/"), base_url).otherwise(F.concat(base_url, F.lit("/")))
    filled = F.replace(F.replace(page_pattern, F.lit("{base_url}"), base), F.lit("{page}"), page.cast("string"))
    return F.when(page == 1, base).otherwise(filled)


def unknown_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Site keys without a rule and how many rows they skip."""
    return (
        df.join(sites.select("site_key"), "site_key", "left_anti")
        .groupBy("site_key")
        .agg(F.count("*").alias("skipped"))
    )
