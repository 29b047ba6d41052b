"""Physical plans: no cross joins, pushed filters, pruned columns, split hot keys."""

import pytest
from pyspark.sql import functions as F

from firmament.operators import dedup, extract, match, report, upsert
from firmament.plans import views
from firmament.session import new_folder
from firmament.sources import snapshots
from tests.test_resolve import assignment, entities, frame, listing, master_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    master = master_of(spark, [(1, None, "А", "a.ru", "Работает", "2024-01-01"), (2, None, "А", "a.ru", "Работает", "2024-01-01")], phones=[(1, "+7 495 1112233"), (2, "74951112233")])
    return frame(spark, entities(1, 5, 20)), master


def test_no_cross_joins(spark, tables):
    listings, master = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = match.key_record(listings)
        records = records.withColumnRenamed("ingest_seq", "seq")
        wanted, slices = match.explode_keys(records, "seq"), upsert.Slices(20)
        rows = records.withColumn("company_id", F.col("seq"))
        offers = upsert.key_offers(rows, upsert.known_offers(wanted, master), slices)
        for df in [
            match.match_batch(listings, master), dedup.website_id_map(master.companies), dedup.name_phone_edges(master),
            report.registry_report(master, has_phone=True, site_key="s"), offers, upsert.parent_pointers(wanted, offers, slices),
        ]:
            text = plan(df)
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_filter_reaches_the_scan(spark):
    folder = new_folder(spark, "pages")
    spark.sql("SELECT 'u' url, 1L page_id, TIMESTAMP '2024-01-01 00:00:00' fetched_at, 'h' html").write.parquet(folder)
    newest = snapshots.latest_snapshots(spark.read.parquet(folder), F.lit("2024-01-10").cast("timestamp"), 14)
    assert "GreaterThanOrEqual(fetched_at" in plan(newest)
    assert newest.count() == 1


def test_only_needed_columns_are_read(spark):
    folder = new_folder(spark, "pages")
    spark.sql("SELECT 1L page_id, 'u' url, 'x@firm.ru' html, 'b' ballast").write.parquet(folder)
    found = extract.page_contacts(spark.read.parquet(folder)).select("page_id", "emails")
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan(found)


def test_hot_key_is_split(spark):
    """Half of the records share one inn: adaptive execution splits their join partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        keys = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("ingest_seq"), F.lit(1).alias("level"),
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        )
        index = keys.groupBy("level", "key").agg(F.min("ingest_seq").alias("first"))
        hits = keys.join(index, ["level", "key"])
        assert hits.count() == 60_000
        hits.write.format("noop").mode("overwrite").save()
        joined = hits.select("ingest_seq", "first")
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_costly_tables_are_dealt_by_rows(spark):
    """Neither one file of one row group nor a count of splits leaves the work to few tasks."""
    cores = spark.sparkContext.defaultParallelism
    assert views.spread(spark.range(0, 100, 1, 1), "customer").rdd.getNumPartitions() == cores
    rows = 3 * cores * views.TASK_ROWS["pages"]
    assert views.spread(spark.range(0, rows, 1, 2 * cores), "pages").rdd.getNumPartitions() == 3 * cores
    assert views.spread(spark.range(0, 100, 1, 1), "nation").rdd.getNumPartitions() == 1


def test_rounds_of_resolution_keep_real_sizes(spark, monkeypatch):
    """The estimated size of what rounds hand on was a product of all sizes joined, its digits multiplied by every round."""
    bits, real = [], upsert._same_companies

    def seen(a, b):
        bits.extend(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() for df in (a, b))
        return real(a, b)

    monkeypatch.setattr(upsert, "_same_companies", seen)
    phone = ["+7 (495) 111-22-33"]
    rows = [listing(0, name="А", phones=phone, website="a.ru"), listing(1, inn="7700000001", website="a.ru"), listing(2, name="А", phones=phone, inn="7700000002")]
    assert assignment(spark, rows) == {0: 0, 1: 0, 2: 2}
    assert bits and max(bits) < 64
