"""Crawl frontier and catalogue state folded from logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.operators.skew import top_k_per_group
from firmament.session import cut

DISCOVERED, COMPLETED, FAILED = "discovered", "completed", "failed"


def insert_links(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """New frontier rows for links not known yet; the first site wins.

    ``links(url, site_key, arrival)``.
    """
    first = links.groupBy("url").agg(F.min(F.struct("arrival", "site_key")).alias("f"))
    return (
        first.join(frontier.select("url"), "url", "left_anti")
        .select("url", "f.site_key", F.lit("pending").alias("status"), F.lit(0).alias("attempts"))
    )


def reopen(frontier: DataFrame, as_of, recrawl_after_days: int) -> DataFrame:
    """Frontier whose completed URLs become pending again once they are old enough."""
    stale = (F.col("status") == COMPLETED) & (
        F.col("updated_at") < F.timestamp_add("DAY", F.lit(-recrawl_after_days), as_of)
    )
    return frontier.withColumn("status", F.when(stale, F.lit("pending")).otherwise(F.col("status")))


def added_by_site(inserted: DataFrame) -> DataFrame:
    """Number of URLs really inserted per site."""
    return inserted.groupBy("site_key").agg(F.count("*").alias("added"))


def state_of(completed, failures, max_attempts: int = fv.MAX_ATTEMPTS):
    return (
        F.when(completed, F.lit("completed"))
        .when(failures >= max_attempts, F.lit("error"))
        .otherwise(F.lit("pending"))
    )


def as_entries(outcomes: DataFrame) -> DataFrame:
    """Log rows in the additive form that folds: flags and counts instead of an outcome."""
    return outcomes.select(
        "url", "event_id", "site_key",
        (F.col("outcome") == COMPLETED).cast("int").alias("done"),
        (F.col("outcome") == FAILED).cast("bigint").alias("failures"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def combine_entries(entries: DataFrame) -> DataFrame:
    """One entry per URL; combining combined entries again gives the same result."""
    return (
        entries.groupBy("url")
        .agg(
            F.min(F.struct("event_id", "site_key")).alias("f"),
            F.max("done").alias("done"),
            F.sum("failures").alias("failures"),
            F.max("ts").alias("ts"),
        )
        .select("url", "f.event_id", "f.site_key", "done", "failures", "ts")
    )


def entry_state(combined: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    return combined.select(
        "url", "site_key",
        state_of(F.col("done") == 1, F.col("failures"), max_attempts).alias("status"),
        F.col("failures").cast("int").alias("attempts"),
        F.col("ts").alias("updated_at"),
    )


def fold_outcomes(outcomes: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """Frontier state of every URL from its outcome log (K1); a completion always wins."""
    return entry_state(combine_entries(as_entries(outcomes)), max_attempts)


def advance_frontier(frontier: DataFrame, outcomes: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """Existing frontier plus a new stretch of the log; processing rows fall back to pending."""
    known = frontier.select(
        "url", F.lit(-1).cast("bigint").alias("event_id"), "site_key",
        (F.col("status") == COMPLETED).cast("int").alias("done"),
        F.col("attempts").cast("bigint").alias("failures"), F.col("updated_at").alias("ts"),
    )
    return entry_state(combine_entries(known.unionByName(as_entries(outcomes))), max_attempts)


def pending_batch(frontier: DataFrame, per_site: int) -> DataFrame:
    """Next ``per_site`` pending URLs of every site in URL order."""
    pending = frontier.filter(F.col("status") == "pending").select("url", "site_key", "attempts")
    return top_k_per_group(pending, ["site_key"], [F.col("url")], per_site, spread_by="url")


def status_counts(frontier: DataFrame) -> DataFrame:
    """URLs by site and status."""
    return frontier.groupBy("site_key", "status").agg(F.count("*").alias("urls"))


def crawl_stats(outcomes: DataFrame) -> DataFrame:
    """Success rate, speed and response time per site."""
    done = F.col("outcome") == COMPLETED
    failed = F.col("outcome") == FAILED
    tried = F.when(done | failed, F.col("ts"))
    totals = outcomes.groupBy("site_key").agg(
        F.countDistinct("url").alias("queue_total"),
        F.count_if(done).alias("success_count"),
        F.count_if(failed).alias("failed_count"),
        F.avg(F.when(done | failed, F.col("response_sec"))).alias("mean_response"),
        (F.unix_micros(F.max(tried).cast("timestamp")) - F.unix_micros(F.min(tried).cast("timestamp"))).alias("micros"),
    )
    processed = F.col("success_count") + F.col("failed_count")
    elapsed = F.coalesce("micros", F.lit(0)) / F.lit(1_000_000)
    return totals.select(
        "site_key",
        "queue_total",
        processed.alias("processed_total"),
        "success_count",
        "failed_count",
        F.round(F.coalesce(F.try_divide(F.col("success_count") * 100.0, processed), F.lit(0.0)), 1).alias("success_rate_percent"),
        F.round(F.coalesce(F.try_divide(processed * 60.0, elapsed), F.lit(0.0)), 1).alias("cards_per_minute"),
        F.round(F.coalesce("mean_response", F.lit(0.0)), 3).alias("avg_response_time_sec"),
        F.round(elapsed, 1).alias("elapsed_time_sec"),
    )


def catalog_stop(page_links: DataFrame) -> DataFrame:
    """Listing pages before the first empty page or the first repeat of a link set.

    ``page_links(site_key, page_no, links)``.  A page repeats when a lower page of the
    site has the same set, so only the lowest page of a set is not a repeat.  The
    narrow set table is kept, so that pages are parsed once.
    """
    sets = cut(
        page_links.select(
            "site_key", "page_no",
            F.size("links").alias("n"),
            F.sha2(F.array_join(F.array_sort(F.array_distinct("links")), "\n"), 256).alias("set_key"),
        )
    )
    lowest = sets.groupBy("site_key", "set_key").agg(F.min("page_no").alias("lowest"))
    stops = (
        sets.join(lowest, ["site_key", "set_key"])
        .filter((F.col("n") == 0) | (F.col("page_no") > F.col("lowest")))
        .groupBy("site_key")
        .agg(F.min("page_no").alias("stop_page"))
    )
    return (
        sets.select("site_key", "page_no", F.col("n").alias("link_count"))
        .join(stops, "site_key", "left")
        .filter(F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page")))
    )
