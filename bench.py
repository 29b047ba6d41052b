"""Timings of the headline queries as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firmament.session import BUILD_SETTINGS  # noqa: E402

HEADLINE = [
    "normalize_listings",
    "website_groups",
    "page_links",
    "catalog_stop",
    "page_emails",
    "doc_contacts",
    "site_scan",
    "card_fields",
    "match_cascade",
    "upsert_companies",
    "survivorship",
    "dedup_companies",
    "provider_chain",
    "official_update",
    "quota_assignment",
    "frontier_state",
    "crawl_stats",
    "latest_snapshot",
    "registry_report",
    "report_topk",
    "settled_registry",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("firmament-bench")
        .config("spark.ui.enabled", "false")
        .config(map=BUILD_SETTINGS)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from firmament.plans.queries import QUERIES

    wanted = sys.argv[1:] or HEADLINE
    QUERIES["source_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    timings = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
