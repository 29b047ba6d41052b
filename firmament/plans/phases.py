"""The three phases of the engine composed from operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from firmament.operators.cards import extract_cards
from firmament.operators.dedup import dedup_pass
from firmament.operators.enrich import add_site_contacts, enrich_master, scan_candidates
from firmament.operators.extract import link_rows, page_card_links, scan_sites, scan_totals, usable_pages
from firmament.operators.frontier import catalog_stop, insert_links
from firmament.operators.records import normalize_listings
from firmament.operators.report import registry_report
from firmament.operators.upsert import upsert_batch
from firmament.schemas import Master
from firmament.session import cut


def discover(listing_pages: DataFrame, rules: DataFrame, frontier: DataFrame) -> DataFrame:
    """Listing pages to new frontier rows, catalogue loops cut off."""
    return frontier_rows(page_card_links(listing_pages, rules), frontier)


def frontier_rows(page_links: DataFrame, frontier: DataFrame) -> DataFrame:
    """New frontier rows out of the links of listing pages; the first site of an address wins."""
    linked = cut(page_links)
    usable = catalog_stop(linked).select("site_key", "page_no")
    links = link_rows(linked.join(usable, ["site_key", "page_no"], "left_semi"))
    return insert_links(frontier, links.withColumnRenamed("page_no", "arrival"))


def collect(card_pages: DataFrame, master: Master) -> tuple[Master, DataFrame]:
    """Card pages to a resolved and deduplicated master, with the merge log."""
    return resolve(normalize_listings(extract_cards(card_pages)), master)


def resolve(listings: DataFrame, master: Master) -> tuple[Master, DataFrame]:
    """Normalised records to a resolved and deduplicated master, with the merge log."""
    return dedup_pass(upsert_batch(listings, master))


def scan_websites(master: Master, pages: DataFrame, seen_at: Column, limit: int = 0, **lists) -> tuple[Master, DataFrame, DataFrame]:
    """Company sites to new contacts; returns the master, what was added, and the totals of the scan."""
    wanted = cut(scan_candidates(master, limit))
    usable = usable_pages(pages)
    scanned, inserted = add_site_contacts(master, scan_sites(wanted, usable, **lists), seen_at)
    inserted = cut(inserted)
    return scanned, inserted, scan_totals(wanted, usable, inserted)


def enrich(master: Master, responses: DataFrame, as_of: Column, **options) -> Master:
    return enrich_master(master, responses, as_of, **options)


def report(master: Master, **options) -> DataFrame:
    return registry_report(master, **options)
