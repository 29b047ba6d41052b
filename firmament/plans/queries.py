"""Registered queries: one per operator or report, on tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament.functions import html as H
from firmament.functions import normalize as N
from firmament.functions import registry as R
from firmament.functions import urls as U
from firmament.functions.contacts import is_valid_email
from firmament.operators import cards, children, dedup, enrich, extract, frontier, match, quality, report, upsert
from firmament.operators.records import website_groups as grouped_websites
from firmament.plans import phases, views
from firmament.schemas import COMPANIES, PAGES, empty_master
from firmament.session import cut, new_folder
from firmament.sources import sites, snapshots
from firmament.sources.registry import RegistryStore, read_report, write_report, write_stats
from firmament.streaming import discovery as stream_discovery_job
from firmament.streaming import frontier as stream_frontier_job
from firmament.streaming import upsert as stream_upsert_job

SPLIT_DATE = "1997-01-01"
AS_OF = "2024-06-02 00:00:00"
CORPUS_LOCALS = ["noreply", "no-reply"]
CORPUS_DOMAINS = ["mail1.example.com"]
CORPUS_SITES = [(f"site{i}", f"http://site{i}.example.net/catalog/", "corpus", "{base_url}?page={page}") for i in range(10)]
CORPUS_RULES = [("corpus", "http://cards.example.net", None, "^/([a-zA-Z]+)$", ["The", "and", "De"], "/firm/")]

QUERIES = {}


def query(fn):
    """Register ``fn(spark)`` or ``fn(spark, sf_dir)``; the tables are loaded before it runs."""
    with_folder = fn.__code__.co_argcount == 2

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views.load(spark, sf_dir)
        return fn(spark, sf_dir) if with_folder else fn(spark)

    QUERIES[fn.__name__] = run
    return run


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def joined(c, separator=","):
    return F.array_join(c, separator)


# --- Normalisation and column functions ----------------------------------------


@query
def normalize_listings(spark):
    return views.normalized(spark).select(
        "source_url", "site_key", "ingest_seq", "inn", "name", "website", joined("phones").alias("phones"),
        joined("emails").alias("emails"), joined("kpp_list").alias("kpp_list"), "address",
        "status_aggregator", "scrape_date", "last_seen_at",
    )


@query
def website_groups(spark):
    return grouped_websites(views.normalized(spark).withColumn("company_id", F.col("ingest_seq")))


@query
def phone_fingerprints(spark):
    """Name and fingerprint keys that several records share."""
    keys = match.record_keys(views.normalized(spark)).filter(F.col("level") == match.NAME_PHONE)
    return (
        keys.select(F.split("key", "\u001f").alias("k"), "ingest_seq")
        .groupBy(F.col("k")[0].alias("name_norm"), F.col("k")[1].alias("fp"))
        .agg(F.count("*").alias("listings"), F.min("ingest_seq").alias("first_seq"))
        .filter(F.col("listings") > 1)
    )


@query
def email_validity(spark):
    found = spark.table("documents").select("doc_id", F.explode(H.text_emails(F.col("text"))).alias("email"))
    return found.select(
        "doc_id", "email",
        is_valid_email("email").cast("int").alias("valid_default"),
        is_valid_email("email", CORPUS_LOCALS, CORPUS_DOMAINS).cast("int").alias("valid_corpus"),
    )


@query
def value_lists(spark):
    """Fields that come as a scalar, blank or missing in one place and as a list in another, as one list."""
    rows = spark.table("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, "   ").when(F.col("c_custkey") % 4 != 1, F.col("c_mktsegment")).alias("one"),
        F.when(F.col("c_custkey") % 3 == 0, F.array("c_name", "c_mktsegment")).alias("many"),
    )
    return rows.select(
        F.col("c_custkey").alias("custkey"), joined(N.as_list("one"), "|").alias("one"),
        joined(F.concat(N.as_list("one"), N.list_or_empty("many")), "|").alias("both"),
    )


@query
def status_labels(spark):
    status = R.report_status("status_official", "liquidation_date", "inn")
    return spark.sql(views.FX_COMPANIES).select("company_id", status.alias("registry_status")).select(
        "company_id", "registry_status", R.status_code("registry_status").alias("code"),
        R.status_label("registry_status").alias("label"),
    )


@query
def date_parse(spark):
    cols = ["registration_date", "official_verified_at", "scrape_date"]
    return spark.sql(views.FX_COMPANIES).select(
        "company_id", *[F.date_format(N.parse_date(c), "yyyy-MM-dd").alias(c) for c in cols],
        N.dotted_to_iso("registration_date").alias("registration_iso"),
    )


@query
def contact_summaries(spark):
    return views.normalized(spark).select(
        "ingest_seq", N.contact_summary("phones", "emails", "kpp_list").alias("summary")
    )


@query
def set_ops(spark):
    """Union, intersection, difference and equality of the site sets before and after a date."""
    rows = views.normalized(spark)
    early = F.col("scrape_date") < SPLIT_DATE
    sets = rows.groupBy("custkey").agg(
        F.sort_array(F.collect_set(F.when(early, F.col("site_key")))).alias("a"),
        F.sort_array(F.collect_set(F.when(~early, F.col("site_key")))).alias("b"),
    )
    return sets.select(
        "custkey",
        joined(F.array_sort(F.array_union("a", "b"))).alias("either"),
        joined(F.array_sort(F.array_intersect("a", "b"))).alias("both"),
        joined(F.array_sort(F.array_except("a", "b"))).alias("only_early"),
        F.arrays_overlap("a", "b").cast("int").alias("overlap"),
        (F.col("a") == F.col("b")).cast("int").alias("equal"),
    )


@query
def link_resolution(spark):
    pages = spark.table("pages")
    return pages.select("page_id", "url", F.posexplode(H.link_targets("html")).alias("pos", "href")).select(
        "page_id", "pos", "href", U.resolve("url", "href").alias("resolved"),
        U.netloc("url").alias("host"), U.path("url").alias("base_path"), U.url_key("url").alias("url_key"),
    )


# --- Extraction ------------------------------------------------------------------


@query
def page_links(spark):
    rules = sites.link_rules(spark, CORPUS_SITES, CORPUS_RULES)
    return extract.extract_links(spark.sql(views.FX_CATALOG), rules)


@query
def catalog_stop(spark):
    rules = sites.link_rules(spark, CORPUS_SITES, CORPUS_RULES)
    return frontier.catalog_stop(extract.page_card_links(spark.sql(views.FX_CATALOG), rules))


@query
def discovered_frontier(spark):
    """Listing pages to new frontier rows; what the fetch log knows already stays out."""
    rules = sites.link_rules(spark, CORPUS_SITES, CORPUS_RULES)
    return phases.discover(spark.sql(views.FX_CATALOG), rules, frontier.fold_outcomes(views.outcomes(spark)))


@query
def catalogue_links(spark):
    """Card links of the four real catalogue layouts, by their own rules."""
    views.deal(spark, "customer")
    return extract.extract_links(spark.sql(views.FX_CATALOGUES), sites.link_rules(spark))


@query
def page_emails(spark):
    return spark.table("pages").select("page_id", F.explode(extract.page_emails("html")).alias("email"))


@query
def page_phones(spark):
    phones = H.text_phones(H.visible_text("html"))
    return spark.table("pages").select("page_id", F.explode(phones).alias("phone"))


@query
def doc_contacts(spark):
    found = extract.text_contacts(
        spark.table("documents").select("doc_id", "text"), "text",
        junk_local_parts=CORPUS_LOCALS, junk_domains=CORPUS_DOMAINS,
    )
    return found.filter((F.size("emails") > 0) | (F.size("phones") > 0)).select(
        "doc_id", joined(F.array_sort("emails")).alias("emails"), joined(F.array_sort("phones")).alias("phones")
    )


@query
def protected_contacts(spark):
    """Addresses in mail links, encoded attributes and linked data; broken forms give none."""
    views.deal(spark, "customer")
    found = extract.page_contacts(spark.sql(views.FX_PROTECTED).select("custkey", "html"))
    return found.select("custkey", F.explode("emails").alias("email"))


@query
def contact_links(spark):
    pages = spark.sql(views.FX_SITE_PAGES)
    links = extract.contact_links(F.col("url"), "html")
    return pages.select("url", F.posexplode(links).alias("pos", "link"))


@query
def site_scan(spark):
    companies = spark.table("pages").select(
        F.col("page_id").alias("company_id"), F.concat(F.lit("site"), "page_id", F.lit(".example.net")).alias("website")
    )
    return extract.scan_sites(companies, spark.sql(views.FX_SITE_PAGES),
                              junk_local_parts=CORPUS_LOCALS, junk_domains=CORPUS_DOMAINS)


def corpus_cards(spark):
    return cards.extract_cards(
        spark.table("pages").select(
            "url", F.lit("corpus").alias("site_key"),
            F.when(F.col("page_id") % 2 == 0, "site_a").otherwise("site_b").alias("rule_key"),
            F.lit("2024-01-01").alias("scrape_date"), F.col("page_id").alias("ingest_seq"), "html",
        ),
        {key: cards.CARD_RULES[key] for key in ("site_a", "site_b")},
    )


@query
def card_fields(spark):
    return corpus_cards(spark).select(
        "source_url", "ingest_seq", "name", "website", "inn", joined("phones").alias("phones"),
        joined("emails").alias("emails"), "status_aggregator", "scrape_date",
    )


def _rule_cards(spark, rule):
    """Cards of one layout, written out of orders, with all fields read back."""
    pages = spark.sql(views.FX_CARDS).filter(F.col("rule_key") == rule).select(
        "url", F.col("rule_key").alias("site_key"), "rule_key", F.lit("2024-01-01").alias("scrape_date"), "ingest_seq", "html")
    found = cards.extract_cards(pages, {rule: cards.CARD_RULES[rule]})
    return found.select(
        "ingest_seq", "name", "legal_name", "inn", "ogrn", "registration_date", "director", "address", "website",
        joined("phones").alias("phones"), joined("emails").alias("emails"), joined("kpp_list").alias("kpp_list"), "status_aggregator",
    )


@query
def cards_site_a(spark):
    return _rule_cards(spark, "site_a")


@query
def cards_site_b(spark):
    return _rule_cards(spark, "site_b")


@query
def cards_site_c(spark):
    return _rule_cards(spark, "site_c")


@query
def cards_site_d(spark):
    return _rule_cards(spark, "site_d")


def _site_phase(spark):
    """The scan phase over companies of which some have no answer, some a file and some a known contact."""
    text = F.lit(None).cast("string")
    rows = spark.sql(views.FX_SCANNED)
    companies = rows.select(*[F.col(f.name) if f.name in rows.columns else text.alias(f.name) for f in COMPANIES])
    day = F.lit("2024-01-01")
    contacts = rows.filter(F.col("company_id") % 5 == 0).select(
        "company_id", F.lit("phone").alias("contact_type"), F.lit("+7 (495) 000-00-00").alias("value"), day.alias("first_seen_at"), day.alias("last_seen_at"))
    master = empty_master(spark).with_tables(companies=companies, contacts=contacts)
    return phases.scan_websites(master, spark.sql(views.FX_FETCHED_PAGES), F.lit("2024-06-01"),
                                junk_local_parts=CORPUS_LOCALS, junk_domains=CORPUS_DOMAINS)


@query
def scan_phase(spark):
    """Contacts that a scan of company sites adds."""
    return _site_phase(spark)[1].select("company_id", "contact_type", "value", "first_seen_at")


@query
def scan_totals(spark):
    """Companies scanned, those whose site did not answer with text, and what was added."""
    return _site_phase(spark)[2]


# --- Matching and upsert ---------------------------------------------------------


def _match_level(spark, level):
    return match.candidates(
        views.incoming(spark, SPLIT_DATE), views.master_of(spark, SPLIT_DATE), [match.LEVELS[level]]
    ).select("ingest_seq", "company_id")


@query
def match_inn(spark):
    return _match_level(spark, "inn")


@query
def match_website(spark):
    return _match_level(spark, "website")


@query
def match_source(spark):
    """Replayed cards: every record of the master comes in again, stripped of other keys."""
    again = views.normalized(spark).drop("custkey").withColumns(
        {"inn": F.lit(None).cast("string"), "website": F.lit(None).cast("string"), "name": F.lit(None).cast("string")}
    )
    found = match.match_batch(again, views.master_of(spark, SPLIT_DATE))
    return found.filter(F.col("company_id").isNotNull())


@query
def match_name_phone(spark):
    return _match_level(spark, "name_phone")


@query
def match_cascade(spark):
    return match.match_batch(views.incoming(spark, SPLIT_DATE), views.master_of(spark, SPLIT_DATE))


@query
def assigned_companies(spark):
    """Company of every incoming record, batch-internal matches included."""
    found = upsert.assign_companies(views.incoming(spark, SPLIT_DATE), views.master_of(spark, SPLIT_DATE))
    return found.select("ingest_seq", "company_id")


@query
def repeated_arrivals(spark):
    """Company of every record when arrival numbers repeat inside a batch and start again in the next."""
    rows = cut(views.normalized(spark).drop("custkey").withColumn("ingest_seq", F.col("ingest_seq") % 50))
    early = F.col("scrape_date") < SPLIT_DATE
    master = upsert.upsert_batch(rows.filter(early), empty_master(spark))
    master = master.with_tables(**{name: cut(table) for name, table in master.all_tables().items()})
    later = upsert.assign_companies(rows.filter(~early), master).select("source_url", "company_id")
    return master.sources.select("source_url", "company_id").unionByName(later)


@query
def stored_deltas(spark):
    """Records in three shuffled deliveries, each a delta of the store; buckets with two deltas are compacted."""
    store = RegistryStore(spark, new_folder(spark, "registry"), buckets=8, deltas=2)
    rows = cut(views.normalized(spark).drop("custkey"))
    for delivery in range(3):
        part = rows.filter(F.col("ingest_seq") % 3 == delivery)
        store.update(lambda master, part=part: upsert.upsert_changes(part, master), delivery)
    return store.read().companies.select(*COMPANY_COLUMNS)


def _upserted(spark):
    return upsert.upsert_batch(views.incoming(spark, SPLIT_DATE), views.master_of(spark, SPLIT_DATE))


COMPANY_COLUMNS = [
    "company_id", "inn", "name", "website", "address", "status_aggregator",
    "first_seen_at", "last_seen_at", "scrape_date",
]


@query
def upsert_companies(spark):
    return _upserted(spark).companies.select(*COMPANY_COLUMNS)


@query
def upsert_sources(spark):
    return _upserted(spark).sources


@query
def upsert_contacts(spark):
    return _upserted(spark).contacts


@query
def upsert_kpp(spark):
    return _upserted(spark).kpp


def _founded(spark):
    """All records of a customer under the first one's id."""
    rows = cut(views.normalized(spark))
    ids = rows.groupBy("custkey").agg(F.min("ingest_seq").alias("company_id"))
    return rows.join(ids, "custkey").drop("custkey")


@query
def survivorship(spark):
    return upsert.fold_companies(empty_master(spark).companies, _founded(spark)).select(*COMPANY_COLUMNS)


@query
def child_contacts(spark):
    return children.upsert_contacts(empty_master(spark).contacts, children.listing_contacts(_founded(spark)))


@query
def child_sources(spark):
    return children.upsert_sources(empty_master(spark).sources, children.listing_sources(_founded(spark)))


@query
def child_kpp(spark):
    return children.upsert_kpp(empty_master(spark).kpp, children.listing_kpp(_founded(spark)))


@query
def website_contact_counts(spark):
    """New contacts per company when website finds meet the contacts on file."""
    known = views.master(spark).contacts
    found = children.listing_contacts(_founded(spark)).select("company_id", "contact_type", "value")
    inserted = children.new_contacts(known, enrich.found_contacts(found, F.lit("2024-06-01")))
    return children.new_contact_counts(inserted)


# --- Deduplication ---------------------------------------------------------------


@query
def dedup_website(spark):
    return dedup.website_id_map(views.raw_master(spark).companies).drop("no_inn")


@query
def name_phone_edges(spark):
    return dedup.name_phone_edges(views.raw_master(spark))


@query
def dedup_components(spark):
    return dedup.name_phone_id_map(views.raw_master(spark)).drop("no_inn")


@query
def dedup_companies(spark):
    return dedup.dedup_pass(views.raw_master(spark))[0].companies.select(*COMPANY_COLUMNS)


@query
def dedup_contacts(spark):
    return dedup.dedup_pass(views.raw_master(spark))[0].contacts


@query
def dedup_sources(spark):
    return dedup.dedup_pass(views.raw_master(spark))[0].sources


@query
def merge_log(spark):
    return dedup.dedup_pass(views.raw_master(spark))[1]


@query
def dedup_totals(spark):
    return dedup.dedup_totals(dedup.dedup_pass(views.raw_master(spark))[1])


# --- Reports ---------------------------------------------------------------------


@query
def registry_report(spark):
    return report.registry_report(views.master(spark))


@query
def report_filtered(spark):
    return report.registry_report(
        views.master(spark), sort_by=[("inn", "DESC"), ("name", "ASC")],
        city="nation_1", site_key="site1", has_inn=True, has_phone=True,
    )


@query
def report_status_filter(spark):
    return report.registry_report(views.master(spark), sort_by=[("last_seen_at", "DESC")], status_official="BANKRUPT")


@query
def report_topk(spark):
    return report.registry_report(views.master(spark), sort_by=[("source_count", "DESC"), ("unknown", "ASC")], limit=100)


@query
def report_parts(spark):
    """The report with a tiny cell size, so that most companies need continuation rows."""
    return report.registry_report(views.master(spark), cell_values=2).select(
        "company_id", "part", "name", "phones", "emails", "kpp", "sources"
    )


@query
def report_typed(spark):
    return report.typed_report(report.registry_report(views.master(spark))).select(
        "company_id", "inn", "ogrn", "kpp", "registration_date", "status_code", "status_label",
        *[
            F.date_format(f"{c}_parsed", "yyyy-MM-dd").alias(f"{c}_parsed")
            for c in ["registration_date", "official_verified_at", "scrape_date"]
        ],
    )


@query
def companies_with_contacts(spark):
    return report.companies_with_contacts(views.master(spark))


@query
def source_counts(spark):
    return report.source_counts(views.master(spark))


# --- Enrichment ------------------------------------------------------------------


@query
def payload_results(spark):
    return enrich.provider_results(views.responses(spark))


@query
def provider_chain(spark):
    return enrich.provider_chain(enrich.provider_results(views.responses(spark)))


@query
def fresh_responses(spark):
    """Newest answer per provider and inn that is at most a day old."""
    aged = views.responses(spark).withColumn(
        "fetched_at",
        F.timestamp_add("HOUR", -(F.substring("inn", 4, 7).cast("int") % 48), F.col("fetched_at")),
    )
    return snapshots.fresh_responses(aged, as_of(), 1).select(
        "provider", "inn", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "payload"
    )


@query
def enrich_candidates(spark):
    return enrich.enrich_candidates(views.master(spark), as_of(), recheck_days=60)


@query
def enrich_batch(spark):
    """The next companies to check in one city and on one site."""
    return enrich.enrich_candidates(views.master(spark), as_of(), limit=50, recheck_days=60, city="NATION_2", site_key="site2")


PROVIDERS = [
    enrich.Provider("A", 1, "nested", daily_limit=40),
    enrich.Provider("B", 2, "rows", daily_limit=60),
    enrich.Provider("C", 3, "rows", daily_limit=1000, enabled=False),
]


@query
def quota_assignment(spark):
    requests = views.master(spark).companies.filter(F.col("inn").isNotNull()).select(
        "inn", F.col("scrape_date").substr(1, 4).alias("day"), "company_id",
        "status_official", "status_aggregator", "official_verified_at",
    )
    return enrich.assign_quota(requests, PROVIDERS)


@query
def official_update(spark):
    updated = enrich.enrich_master(views.master(spark), views.responses(spark), as_of(), recheck_days=60)
    return updated.companies.select(
        "company_id", "inn", "status_official", "inn_verified", "legal_name_official", "official_verified_at",
        "provider_name", "liquidation_date", "director_official", "address_official",
    )


@query
def official_newest(spark):
    """Several answers per provider and inn: older ones that say otherwise, and stale ones alone."""
    updated = enrich.enrich_master(views.master(spark), views.many_responses(spark), as_of(), ttl_days=30, recheck_days=60)
    return updated.companies.select("company_id", "inn", "status_official", "official_verified_at", "provider_name", "director_official")


@query
def enrichment_totals(spark):
    wanted = enrich.enrich_candidates(views.master(spark), as_of(), recheck_days=60)
    answers = enrich.provider_chain(enrich.provider_results(views.responses(spark)))
    return enrich.enrichment_totals(wanted, answers, F.lit("2024-06-01 12:01:10").cast("timestamp"))


@query
def scan_candidates(spark):
    return enrich.scan_candidates(views.master(spark))


# --- Frontier, statistics, snapshots ---------------------------------------------


@query
def frontier_state(spark):
    state = frontier.fold_outcomes(views.outcomes(spark))
    return state.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query
def frontier_advance(spark):
    log = views.outcomes(spark)
    first = frontier.fold_outcomes(log.filter(F.col("event_id") % 2 == 0))
    state = frontier.advance_frontier(first, log.filter(F.col("event_id") % 2 == 1))
    return state.drop("site_key").withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def _new_links(spark):
    """Links of the later half of the log against the frontier of the earlier half."""
    log = views.outcomes(spark).withColumn("arrival", F.col("event_id"))
    middle = F.lit("2024-01-08").cast("timestamp_ntz")
    known = frontier.fold_outcomes(log.filter(F.col("ts") < middle))
    return frontier.insert_links(known, log.filter(F.col("ts") >= middle).select("url", "site_key", "arrival"))


@query
def frontier_insert(spark):
    return _new_links(spark)


@query
def frontier_added(spark):
    return frontier.added_by_site(_new_links(spark))


@query
def pending_batch(spark):
    return frontier.pending_batch(frontier.fold_outcomes(views.outcomes(spark)), 10)


@query
def pending_counts(spark):
    return frontier.status_counts(frontier.fold_outcomes(views.outcomes(spark)))


@query
def crawl_stats(spark):
    return frontier.crawl_stats(views.outcomes(spark))


@query
def latest_snapshot(spark):
    newest = snapshots.latest_snapshots(
        spark.sql(views.FX_SNAPSHOTS), F.lit("2024-03-15 00:00:00").cast("timestamp"), 14
    )
    return newest.select(
        "url", "page_id", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        F.md5("html").alias("html_md5"),
    )


@query
def snapshot_history(spark):
    return snapshots.snapshot_history(spark.sql(views.FX_SNAPSHOTS)).withColumn(
        "fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def unknown_sites(spark):
    known = sites.site_table(spark, CORPUS_SITES[:2])
    return sites.unknown_sites(views.outcomes(spark), known)


# --- Stored tables and files -----------------------------------------------------


@query
def page_store(spark):
    """Pages appended in two deliveries and read back."""
    folder = new_folder(spark, "page-store")
    pages = spark.table("pages").select(
        "page_id", "url", F.col("url").alias("final_url"), F.concat(F.lit("site"), F.col("page_id") % 4).alias("site_key"),
        F.lit("card").alias("kind"), (F.col("page_id") % 7).cast("int").alias("page_no"), F.lit("text/html").alias("content_type"),
        as_of().alias("fetched_at"), "html",
    )
    for part in (F.col("page_id") % 2 == 0, F.col("page_id") % 2 == 1):
        snapshots.append_pages(pages.filter(part), folder)
    return snapshots.read_pages(spark, folder).select("page_id", "url", "site_key", "kind", "page_no", F.md5("html").alias("html_md5"))


@query
def response_store(spark):
    """Answers stored by provider and read back; those without a payload are not kept."""
    folder = new_folder(spark, "response-store")
    answers = views.responses(spark)
    without = F.when(F.col("inn").cast("bigint") % 7 != 0, F.col("payload"))
    snapshots.append_responses(answers.withColumn("payload", without), folder)
    return snapshots.read_responses(spark, folder).select(
        "provider", "inn", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "payload"
    )


@query
def stats_file(spark):
    """Crawl statistics written as JSON and read back."""
    folder = new_folder(spark, "stats")
    stats = frontier.crawl_stats(views.outcomes(spark))
    write_stats(stats, folder)
    return spark.read.schema(stats.schema).json(folder)


@query
def report_file(spark):
    """The report as a file with a header, read back by its names; an empty report leaves no file."""
    wide = report.registry_report(views.master(spark)).select("company_id", "part", "name", "address", "phones", "sources")
    folder = new_folder(spark, "report")
    if write_report(wide.filter(F.lit(False)), folder):
        raise RuntimeError("an empty report was written")
    write_report(wide, folder)
    return read_report(spark, folder, wide.schema)


@query
def usable_pages(spark):
    """Pages that stayed on their site and hold text, out of redirects of five kinds."""
    return extract.usable_pages(spark.sql(views.FX_REDIRECTS)).select("page_id", "final_url", "content_type")


@query
def outgoing_links(spark):
    links = spark.sql(views.FX_OUTGOING)
    return links.select(
        "custkey", U.unwrap_website("href", "label").alias("unwrapped"), U.drop_query("href", "label").alias("without_query")
    )


# --- Streams ---------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    """The events table as a stream of fetch outcomes, in the shape of the batch view."""
    events = spark.readStream.schema(spark.table("events").schema).parquet(f"{sf_dir}/events*.parquet")
    url = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), (F.col("event_id") % 7).cast("string"))
    return events.select(
        url.alias("url"), F.concat(F.lit("site"), (F.col("user_id") % 4).cast("string")).alias("site_key"),
        "event_id", "ts",
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed")
        .otherwise("discovered").alias("outcome"),
        F.col("value").alias("response_sec"),
    )


@query
def stream_frontier(spark, sf_dir):
    folder, checkpoint = new_folder(spark, "frontier"), new_folder(spark, "progress")
    stream_frontier_job.start_frontier(_event_stream(spark, sf_dir), folder, checkpoint).awaitTermination()
    state = stream_frontier_job.read_frontier(spark, folder)
    return state.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_discovery(spark):
    """Listing pages land out of order in three deliveries, some first as an empty answer; one delivery comes twice."""
    inbox, folder, checkpoint = (new_folder(spark, name) for name in ("pages", "discovered", "progress"))
    landed = spark.sql(views.FX_LANDED)
    fields = [F.col(f.name).cast(f.dataType) if f.name in landed.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in PAGES]
    rules = sites.link_rules(spark, CORPUS_SITES, CORPUS_RULES)
    for part in (2, 0, 1, 0):
        snapshots.append_pages(landed.filter(F.col("delivery") == part).select(*fields), inbox)
        stream_discovery_job.start_discovery(snapshots.stream_pages(spark, inbox), rules, folder, checkpoint).awaitTermination()
    return stream_discovery_job.read_discovered(spark, folder, frontier.fold_outcomes(views.outcomes(spark)))


@query
def stream_upsert(spark):
    """Records arrive as files in two deliveries and pass through the streaming upsert."""
    inbox = new_folder(spark, "inbox")
    rows = views.normalized(spark).drop("custkey")
    store = RegistryStore(spark, new_folder(spark, "registry"))
    checkpoint = new_folder(spark, "progress")
    for part in (F.col("scrape_date") < SPLIT_DATE, F.col("scrape_date") >= SPLIT_DATE):
        rows.filter(part).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        stream_upsert_job.start_upsert(stream, store, checkpoint).awaitTermination()
    return store.read().companies.select("company_id", "inn", "website", "first_seen_at")


# --- Quality ---------------------------------------------------------------------


@query
def quality_uniqueness(spark):
    return quality.uniqueness_violations(views.raw_master(spark), frontier.fold_outcomes(views.outcomes(spark)))


@query
def quality_domain(spark):
    master = views.master(spark)
    spoiled = master.with_tables(
        companies=master.companies.withColumn(
            "status_official", F.when(F.col("company_id") % 50 == 0, "GONE").otherwise(F.col("status_official"))
        )
    )
    return quality.domain_violations(spoiled)


@query
def quality_referential(spark):
    master = views.master(spark)
    return quality.orphans(master.with_tables(companies=master.companies.filter(F.col("status_official").isNull())))


# --- All phases ----------------------------------------------------------------


@query
def settled_registry(spark):
    """Records to resolved, deduplicated, enriched and reported companies."""
    master, _ = phases.resolve(views.normalized(spark).drop("custkey"), empty_master(spark))
    master = master.with_tables(companies=cut(master.companies))
    enriched = phases.enrich(master, views.responses(spark), as_of())
    return phases.report(enriched, sort_by=[("name", "ASC")])
