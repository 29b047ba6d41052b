"""Registered queries against their SQL on the smallest tables.

``tests/compare.py`` runs all of them at any scale; here the ones that finish quickly.
"""

import os

import pytest

import __spark_entry__ as entry
from firmament.plans.oracle import ORACLE
from firmament.plans.queries import QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "normalize_listings", "website_groups", "phone_fingerprints", "email_validity", "status_labels", "date_parse", "set_ops",
    "link_resolution", "page_links", "catalog_stop", "doc_contacts", "contact_links", "match_cascade", "survivorship",
    "child_contacts", "dedup_website", "name_phone_edges", "registry_report", "report_parts", "report_filtered",
    "provider_chain", "official_update", "quota_assignment", "frontier_state", "pending_batch", "crawl_stats",
    "snapshot_history", "quality_uniqueness", "cards_site_a", "cards_site_b", "cards_site_c", "cards_site_d", "protected_contacts",
    "scan_totals", "catalogue_links", "stream_discovery", "report_file", "value_lists",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
