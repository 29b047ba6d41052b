"""Retroactive deduplication of the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions import normalize as N
from firmament.operators.graph import connected_components
from firmament.operators.match import phone_keys
from firmament.schemas import COMPANIES, DATES, FRESH, IMMUTABLE, OFFICIAL, Master, dated_companies
from firmament.session import stored

WEBSITE, NAME_PHONE = "website", "name_phone"
LOG_COLUMNS = ["loser_id", "winner_id", "reason", "key"]


def winner_rank():
    """Order in which members of a cluster win: those with inn first, then the oldest id."""
    return F.struct(F.col("inn").isNull().alias("no_inn"), F.col("company_id"))


def winner_id():
    """First member in that order, from two plain minima."""
    with_inn = F.min(F.when(F.col("inn").isNotNull(), F.col("company_id")))
    return F.coalesce(with_inn, F.min("company_id")).alias("winner_id")


def website_id_map(companies: DataFrame) -> DataFrame:
    """Losers of every group of equal website."""
    sited = companies.filter(F.col("website").isNotNull()).select("company_id", "inn", "website")
    winners = (
        sited.groupBy("website")
        .agg(winner_id(), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .drop("n")
    )
    return (
        sited.join(winners, "website")
        .filter(F.col("company_id") != F.col("winner_id"))
        .select(
            F.col("company_id").alias("loser_id"), "winner_id",
            F.lit(WEBSITE).alias("reason"), F.col("website").alias("key"),
            F.col("inn").isNull().alias("no_inn"),
        )
    )


def name_phone_edges(master: Master, unify_prefix: bool = False) -> DataFrame:
    """Links between companies of equal name that share a phone fingerprint.

    Every member of a ``(name, fingerprint)`` group is linked to the lowest id of the
    group: as many edges as members and the same components as all pairs.
    """
    keys = stored(phone_keys(master, unify_prefix).select("company_id", "name_norm", "key").distinct())
    hubs = (
        keys.groupBy("key")
        .agg(F.min("company_id").alias("a"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )
    return (
        keys.join(hubs, "key")
        .filter(F.col("company_id") != F.col("a"))
        .select("a", F.col("company_id").alias("b"), "name_norm")
        .distinct()
    )


def name_phone_id_map(master: Master, require_compatible_inn: bool = False, unify_prefix: bool = False) -> DataFrame:
    """Losers of every component of the name-and-phone graph.

    With ``require_compatible_inn`` companies of different inn are never merged: a component
    falls into one cluster per inn, and its companies without inn join the winner's cluster.
    """
    edges = stored(name_phone_edges(master, unify_prefix))
    members = connected_components(edges.select("a", "b")).withColumnRenamed("node", "company_id")
    named = master.companies.select("company_id", "inn", N.normalize_name("name").alias("key")).join(
        members, "company_id"
    )
    cluster = ["component"]
    if require_compatible_inn:
        first = named.groupBy("component").agg(F.min(F.when(F.col("inn").isNotNull(), F.struct("company_id", "inn")))["inn"].alias("first_inn"))
        named = named.join(first, "component").withColumn("cluster", F.coalesce("inn", "first_inn", F.lit(""))).drop("first_inn")
        cluster = ["component", "cluster"]
    winners = named.groupBy(*cluster).agg(winner_id())
    return (
        named.join(winners, cluster)
        .filter(F.col("company_id") != F.col("winner_id"))
        .select(
            F.col("company_id").alias("loser_id"), "winner_id",
            F.lit(NAME_PHONE).alias("reason"), "key", F.col("inn").isNull().alias("no_inn"),
        )
    )


def _in_cluster(df: DataFrame, *id_maps: DataFrame) -> DataFrame:
    """Adds ``root``, the winner or the own id after one map and the next, the ``place`` in its cluster and ``moved``.

    The place is that in the last map's cluster, then that in the one before: the order in which
    moving by one map after another takes members.
    """
    df = df.withColumn("root", F.col("company_id"))
    places = []
    for number, id_map in enumerate(id_maps):
        losers = id_map.select(F.col("loser_id").alias("root"), "winner_id", F.col("no_inn").alias("loser_no_inn"))
        places.insert(0, f"place_{number}")
        place = F.struct(F.col("winner_id").isNotNull().alias("moved"), "loser_no_inn", F.col("root").alias("member"))
        df = (
            df.join(losers, "root", "left")
            .withColumns({places[0]: place, "root": F.coalesce("winner_id", "root")})
            .drop("winner_id", "loser_no_inn")
        )
    return df.withColumn("moved", F.greatest(*[F.col(f"{p}.moved") for p in places], F.lit(False))).withColumn(
        "place", F.struct(*places)
    ).drop(*places)


def _merged(companies: DataFrame, id_maps: list[DataFrame], dates: DataFrame | None) -> DataFrame:
    """One row per cluster: winner's values, gaps filled in rank order, fresh fields with their dates."""
    # Inside the first map's cluster members rank by their values, later ones by the place of that cluster.
    later = [F.col("place")[f"place_{n}"].alias(f"place_{n}") for n in range(len(id_maps) - 1, 0, -1)]
    rank = F.struct(*later, winner_rank().alias("own")).alias("rank")

    def first_known(c):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(rank, c)))[c].alias(c)

    def its_date(c):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(rank, f"{c}_date")))[f"{c}_date"].alias(f"{c}_date")

    def of_winner(c):
        return F.min(F.struct(rank, c))[c]

    active = F.lit(fv.AGGREGATOR_ACTIVE)
    return (
        _in_cluster(dated_companies(companies, dates), *id_maps)
        .groupBy("root")
        .agg(
            *[its_date(c) for c in FRESH],
            *[first_known(c) for c in [*IMMUTABLE, *FRESH, "website", *OFFICIAL]],
            F.when(F.bool_or(F.col("status_aggregator") == active), active)
            .otherwise(of_winner("status_aggregator")).alias("status_aggregator"),
            F.min(N.blank_to_null("first_seen_at")).alias("first_seen_at"),
            of_winner("last_seen_at").alias("last_seen_at"),
            of_winner("scrape_date").alias("scrape_date"),
        )
        .withColumnRenamed("root", "company_id")
    )


def merge_companies(companies: DataFrame, id_map: DataFrame) -> DataFrame:
    """Company rows after a merge (M5-M7)."""
    return _merged(companies, [id_map], None).select(*COMPANIES.names)


def merge_master(master: Master, id_map: DataFrame) -> Master:
    """Merge clusters and move their children; losers disappear with the move (M8, U8)."""
    merged = _moved(master, id_map)
    if master.dates is None:
        return merged
    return merged.with_tables(dates=_merged(master.companies, [id_map], master.dates).select(*DATES.names))


def _moved(master: Master, *id_maps: DataFrame) -> Master:
    """All tables but the dates, moved once by one map after another: the rows of a merge by each in turn."""
    fp = N.digits("value")
    is_phone = F.col("contact_type") == "phone"
    contacts = (
        _in_cluster(master.contacts, *id_maps)
        .filter(~(is_phone & F.col("moved") & ~N.usable_fingerprint(fp)))
        .withColumn("identity", F.when(is_phone & N.usable_fingerprint(fp), fp).otherwise(F.col("value")))
        .groupBy(F.col("root").alias("company_id"), "contact_type", "identity")
        .agg(F.min(F.struct("place", "first_seen_at", "value", "last_seen_at")).alias("f"))
        .select("company_id", "contact_type", "f.value", "f.first_seen_at", "f.last_seen_at")
    )
    kpp = (
        _in_cluster(master.kpp, *id_maps)
        .groupBy(F.col("root").alias("company_id"), "kpp")
        .agg(F.min(F.struct("place", "first_seen_at")).alias("f"))
        .select("company_id", "kpp", "f.first_seen_at")
    )
    sources = (
        _in_cluster(master.sources, *id_maps)
        .withColumn("company_id", F.col("root"))
        .select(*master.sources.columns)
    )
    retired = master.retired
    for id_map in id_maps:
        losers = id_map.select(F.col("loser_id").alias("company_id"))
        retired = losers if retired is None else retired.unionByName(losers)
    return master.with_tables(
        companies=_merged(master.companies, list(id_maps), None).select(*COMPANIES.names),
        sources=sources, contacts=contacts, kpp=kpp, retired=retired,
    )


def merge_log(companies: DataFrame, id_map: DataFrame) -> DataFrame:
    """Merges with the tax numbers on both sides, so a lost inn stays visible."""
    inns = companies.select("company_id", "inn")
    return (
        id_map.join(inns.toDF("loser_id", "loser_inn"), "loser_id")
        .join(inns.toDF("winner_id", "winner_inn"), "winner_id")
        .select(*LOG_COLUMNS, "loser_inn", "winner_inn")
    )


def dedup_pass(master: Master) -> tuple[Master, DataFrame]:
    """Both passes: websites, then names and phones of the result.

    Of the result of the first pass only what the second looks at is worked out: names, numbers and phones.
    Then every table that is read moves once, by both maps.
    """
    by_site = stored(website_id_map(master.companies))
    named = stored(_merged(master.companies, [by_site], None).select("company_id", "inn", "name"))
    phones = _in_cluster(master.contacts.filter(F.col("contact_type") == "phone"), by_site).select(
        F.col("root").alias("company_id"), "contact_type", "value"
    )
    by_name = stored(name_phone_id_map(master.with_tables(companies=named, contacts=phones)))
    log = merge_log(master.companies, by_site).unionByName(merge_log(named, by_name))
    merged = _moved(master, by_site, by_name)
    if master.dates is None:
        return merged, log
    # Dates of fields that came without one follow the winner of each pass.
    return merged.with_tables(dates=merge_master(merge_master(master, by_site), by_name).dates), log


def dedup_totals(log: DataFrame) -> DataFrame:
    """Number of merges by pass."""
    return log.groupBy("reason").agg(F.count("*").alias("merges"))
