"""Frontier, snapshots, enrichment, reports, store and streams."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from firmament.operators import enrich, frontier, report, skew, upsert
from firmament.operators.filters import contains_text, sort_columns
from firmament.plans import phases
from firmament.schemas import COMPANIES, LISTINGS, PAGES, Master, empty_master
from firmament.session import new_folder
from firmament.sources import registry, sites, snapshots
from firmament.streaming import discovery
from firmament.streaming import frontier as sf
from firmament.streaming import upsert as su
from tests.test_resolve import frame, listing, master_of

T0 = dt.datetime(2024, 1, 1)


def outcomes(spark, rows):
    return spark.createDataFrame(
        [(u, s, i, T0 + dt.timedelta(seconds=t), o, r) for i, (u, s, t, o, r) in enumerate(rows)],
        "url string, site_key string, event_id long, ts timestamp, outcome string, response_sec double",
    )


LOG = (
    [("a", "s1", 0, "discovered", None)] + [("a", "s1", i, "failed", None) for i in range(1, 6)]
    + [("b", "s1", 10, "failed", 0.5), ("b", "s1", 60, "completed", 0.25)]
    + [("c", "s2", 0, "discovered", None), ("d", "s1", 5, "completed", 0.75), ("d", "s1", 6, "failed", None)]
)


def test_frontier_fold(spark):
    state = frontier.fold_outcomes(outcomes(spark, LOG))
    got = {r.url: (r.site_key, r.status, r.attempts) for r in state.collect()}
    assert got == {"a": ("s1", "error", 5), "b": ("s1", "completed", 1), "c": ("s2", "pending", 0), "d": ("s1", "completed", 1)}
    log = outcomes(spark, LOG)
    first = frontier.fold_outcomes(log.filter("event_id < 4"))
    assert {tuple(r) for r in frontier.advance_frontier(first, log.filter("event_id >= 4")).collect()} == {tuple(r) for r in state.collect()}


def test_frontier_insert(spark):
    known = frontier.fold_outcomes(outcomes(spark, LOG))
    links = spark.createDataFrame([("a", "s9", 1), ("x", "s2", 5), ("x", "s1", 3), ("y", "s1", 4)], "url string, site_key string, arrival int")
    new = frontier.insert_links(known, links)
    assert {tuple(r) for r in new.collect()} == {("x", "s1", "pending", 0), ("y", "s1", "pending", 0)}
    assert [tuple(r) for r in frontier.added_by_site(new).collect()] == [("s1", 2)]


def test_reopen(spark):
    state = frontier.fold_outcomes(outcomes(spark, LOG))
    again = frontier.reopen(state, F.lit(T0 + dt.timedelta(days=7, seconds=30)), 7)
    assert {r.url: r.status for r in again.collect()} == {"a": "error", "b": "completed", "c": "pending", "d": "pending"}


def test_crawl_stats(spark):
    got = {r.site_key: r for r in frontier.crawl_stats(outcomes(spark, LOG)).collect()}
    s1 = got["s1"]
    assert (s1.queue_total, s1.success_count, s1.failed_count, s1.processed_total) == (3, 2, 7, 9)
    assert (s1.success_rate_percent, s1.elapsed_time_sec, s1.avg_response_time_sec) == (22.2, 59.0, 0.5)
    assert s1.cards_per_minute == pytest.approx(9.2)
    assert (got["s2"].success_rate_percent, got["s2"].cards_per_minute, got["s2"].avg_response_time_sec) == (0.0, 0.0, 0.0)


def test_catalog_stop(spark):
    pages = spark.createDataFrame([
        ("s", 1, ["a", "b"]), ("s", 2, ["c"]), ("s", 3, ["b", "a", "a"]), ("s", 4, ["d"]),
        ("e", 1, ["x"]), ("e", 2, []), ("e", 3, ["y"]), ("o", 1, ["x"]), ("o", 2, ["x", "z"]),
    ], "site_key string, page_no int, links array<string>")
    got = {(r.site_key, r.page_no) for r in frontier.catalog_stop(pages).collect()}
    assert got == {("s", 1), ("s", 2), ("e", 1), ("o", 1), ("o", 2)}


def test_streamed_discovery_equals_the_batch_job(spark, tmp_path):
    """Pages in any order and split, fetched again and delivered again, give the rows of one batch."""
    def page(site, no, *links, day=2):
        html = "".join(f'<a href="/firm/{x}/">x</a>' for x in links)
        return Row(site_key=site, page_no=no, page_id=no * 10 + day, fetched_at=T0 + dt.timedelta(days=day), html=html)

    rules = sites.link_rules(
        spark, [("s", "http://s/", "r", "{page}"), ("o", "http://o/", "r", "{page}")], [("r", "http://s", None, "^/firm/([a-z]+)/$", ["skip"], "/firm/")])
    known = spark.createDataFrame([("http://s/firm/old/",)], "url string")
    pages = [page("s", 1, "a", "old"), page("s", 2, "b", "skip"), page("s", 3, "c"), page("s", 4, "b"), page("s", 5, "z"), page("o", 1, "b"), page("o", 2), page("o", 3, "y")]
    stale = [page("s", 1, day=1), page("s", 3, "b", day=1), page("o", 2, "q", day=1)]
    batch = phases.discover(spark.createDataFrame(pages), rules, known)
    want = sorted(map(tuple, batch.collect()))
    assert [w[0] for w in want] == [f"http://s/firm/{x}/" for x in "abc"] and want[1][1] == "o"

    landing = pages + stale
    for trial, cuts in enumerate(([11], [3, 8, 11], list(range(1, 12)))):
        order = random.Random(trial).sample(landing, len(landing))
        folder, inbox, progress = (str(tmp_path / f"{name}{trial}") for name in ("links", "inbox", "progress"))
        assert discovery.read_discovered(spark, folder, known).collect() == []
        for a, b in zip([0, *cuts], cuts):
            part = spark.createDataFrame(order[a:b])
            missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in PAGES if f.name not in part.columns]
            part.select(*[F.col(f.name).cast(f.dataType) for f in PAGES if f.name in part.columns], *missing).select(*PAGES.names).write.mode("append").parquet(inbox)
            if len(cuts) < 5 or b == cuts[-1]:
                discovery.start_discovery(snapshots.stream_pages(spark, inbox), rules, folder, progress).awaitTermination()
        assert sorted(map(tuple, discovery.read_discovered(spark, folder, known).collect())) == want
    discovery.discovery_sink(folder, rules)(spark.createDataFrame(landing), 0)  # a replay
    assert sorted(map(tuple, discovery.read_discovered(spark, folder, known).collect())) == want


def test_top_k_with_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), F.col("id").cast("string").alias("url"))
    got = skew.top_k_per_group(rows, ["g"], [F.col("url")], 5, "url").collect()
    want = {}
    for r in rows.collect():
        want.setdefault(r.g, []).append(r.url)
    assert {(r.g, r.url, r["rank"]) for r in got} == {(g, u, i + 1) for g, us in want.items() for i, u in enumerate(sorted(us)[:5])}


def test_snapshots(spark):
    pages = spark.createDataFrame(
        [("u", 1, T0), ("u", 2, T0 + dt.timedelta(hours=1)), ("u", 3, T0 + dt.timedelta(days=2)), ("u", 4, T0 + dt.timedelta(days=2, hours=5)), ("v", 5, T0)],
        "url string, page_id long, fetched_at timestamp",
    ).withColumn("html", F.col("page_id").cast("string"))

    def latest(as_of, ttl):
        return {(r.url, r.page_id, r.html) for r in snapshots.latest_snapshots(pages, F.lit(as_of), ttl).collect()}

    assert latest(T0 + dt.timedelta(days=3), 14) == {("u", 4, "4"), ("v", 5, "5")}
    assert latest(T0 + dt.timedelta(days=14), 14) == {("u", 4, "4"), ("v", 5, "5")}
    assert latest(T0 + dt.timedelta(days=14, seconds=1), 14) == {("u", 4, "4")}
    assert latest(T0 + dt.timedelta(days=900), 0) == {("u", 4, "4"), ("v", 5, "5")}
    history = {(r.url, r.snapshot_name[-10:], r.page_id) for r in snapshots.snapshot_history(pages).collect()}
    assert history == {("u", "2024-01-01", 2), ("u", "2024-01-03", 3)}


# --- Enrichment --------------------------------------------------------------------


def answer(inn, status="ACTIVE", **data):
    return json.dumps({"suggestions": [{"data": {"inn": inn, "state": {"status": status, **data.pop("state", {})}, **data}}]}, ensure_ascii=False)


def responses(spark, rows):
    return spark.createDataFrame([(p, i, T0, b) for p, i, b in rows], "provider string, inn string, fetched_at timestamp, payload string")


def test_provider_chain(spark):
    rows = responses(spark, [
        ("A", "1", answer("1", "LIQUIDATED", state={"liquidation_date": 1623888000000}, name={"full_with_opf": "", "short_with_opf": "АО"})),
        ("B", "1", '{"rows":[{"i":"1","n":"B1","g":"ДИРЕКТОР: И"}]}'),
        ("A", "2", '{"suggestions":[]}'), ("B", "2", '{"rows":[{"i":"2 2","n":"B2","g":"ЛИКВИДАТОР: П П","e":""}]}'),
        ("A", "3", "not json"), ("B", "3", '{"rows":[]}'),
        ("A", "4", '{"suggestions":[{"data":null}]}'), ("B", "5", '{"rows":[{"i":"5","g":null,"e":"01.02.2020"}]}'), ("A", "6", None),
    ])
    got = {r.inn: r for r in enrich.provider_chain(enrich.provider_results(rows)).collect()}
    assert set(got) == {"1", "2", "4", "5"}
    assert (got["1"].status_official, got["1"].liquidation_date, got["1"].legal_name_official, got["1"].provider_name) == ("LIQUIDATED", "2021-06-17", "АО", "DaData ЕГРЮЛ")
    assert (got["2"].status_official, got["2"].director_official, got["2"].inn_verified, got["2"].address_official) == ("LIQUIDATING", "П П", "22", None)
    assert (got["4"].status_official, got["4"].inn_verified) == ("UNKNOWN", None)
    assert (got["5"].status_official, got["5"].liquidation_date, got["5"].director_official) == ("LIQUIDATED", "2020-02-01", None)
    only_b = [p for p in enrich.PROVIDERS if p.key == "B"]
    assert {r.inn for r in enrich.provider_chain(enrich.provider_results(rows, only_b)).collect()} == {"1", "2", "5"}


def test_quota(spark):
    requests = spark.createDataFrame(
        [(str(i), "d1" if i < 9 else "d2", i, "ACTIVE" if i % 2 else None, "Работает", None) for i in range(12)],
        "inn string, day string, company_id long, status_official string, status_aggregator string, official_verified_at string",
    )
    providers = [enrich.Provider("A", 1, "nested", daily_limit=3), enrich.Provider("B", 2, "rows", daily_limit=2), enrich.Provider("C", 3, "rows", enabled=False)]
    got = {r.inn: r.provider for r in enrich.assign_quota(requests, providers).collect()}
    assert [i for i in range(9) if got[str(i)] == "A"] == [0, 2, 4]
    assert [i for i in range(9) if got[str(i)] == "B"] == [6, 8]
    assert [i for i in range(9) if got[str(i)] is None] == [1, 3, 5, 7]
    assert [got[str(i)] for i in (9, 10, 11)] == ["A", "A", "A"]
    unlimited = [*providers[:1], enrich.Provider("D", 5, "rows")]
    assert {r.provider for r in enrich.assign_quota(requests, unlimited).collect()} == {"A", "D"}


def verified_master(spark, rows):
    """Companies as (id, inn, address, website, status, verified_at)."""
    data = []
    for cid, inn, address, website, status, verified in rows:
        row = dict.fromkeys(COMPANIES.names, None)
        row.update(company_id=cid, inn=inn, address=address, website=website, status_official=status, official_verified_at=verified,
                   status_aggregator="Работает", first_seen_at="2024", last_seen_at="2024", scrape_date="2024")
        data.append(tuple(row.values()))
    return empty_master(spark).with_tables(companies=spark.createDataFrame(data, COMPANIES))


def test_candidates_and_update(spark):
    master = verified_master(spark, [
        (1, "1", "г. Тула", "a.ru", "ACTIVE", "2024-01-01 00:00:00"), (2, "2", "ТУЛА_1", "", None, None), (3, None, "Тула", "c.ru", None, None),
        (4, "4", "Москва", None, "ACTIVE", "2024-05-20 00:00:00"), (5, "5", "Тула", "e.ru", "ACTIVE", "2023-01-01 00:00:00"),
    ])
    as_of = F.lit(dt.datetime(2024, 6, 1))
    assert [r.company_id for r in enrich.enrich_candidates(master, as_of).collect()] == [2, 5, 1]
    assert [r.company_id for r in enrich.enrich_candidates(master, as_of, limit=1, city="тула").collect()] == [2]
    assert [r.company_id for r in master.companies.filter(contains_text("address", "а_1")).collect()] == [2]
    assert [r.company_id for r in enrich.scan_candidates(master).collect()] == [1, 3, 5]
    stored = responses(spark, [("A", "1", answer("1", "BANKRUPT")), ("A", "4", answer("4", "BANKRUPT"))])
    done = enrich.enrich_master(master, stored, as_of, ttl_days=0)
    got = {r.company_id: (r.status_official, r.official_verified_at) for r in done.companies.collect()}
    assert got[1] == ("BANKRUPT", "2024-01-01 00:00:00") and got[4][0] == "ACTIVE" and got[2] == (None, None)
    stale = enrich.enrich_master(master, stored, as_of)  # answers of January are no answers in June
    assert {r.company_id: r.status_official for r in stale.companies.collect()}[1] == "ACTIVE"
    two = stored.withColumn("fetched_at", F.lit(dt.datetime(2024, 5, 9))).unionByName(
        responses(spark, [("A", "1", answer("1", "LIQUIDATED"))]).withColumn("fetched_at", F.lit(dt.datetime(2024, 5, 20))))
    newest = enrich.enrich_master(master, two, as_of)
    assert {r.company_id: r.status_official for r in newest.companies.collect()}[1] == "LIQUIDATED"


# --- Reports and sinks ---------------------------------------------------------------


def test_report(spark):
    master = master_of(spark, [(1, "7700000001", "Б", "b.ru", "Работает", "2024-01-01"), (2, None, "А", None, "Работает", "2024-01-01"), (3, None, None, None, "Работает", "2024-01-01")],
                       phones=[(1, "2"), (1, "1")], emails=[(1, "z@b.ru", "2024-01-01"), (1, "a@b.ru", "2024-01-02")],
                       kpp=[(1, "2", "2024"), (1, "1", "2025")])
    rows = report.registry_report(master).collect()
    assert [r.company_id for r in rows] == [2, 1, 3]
    assert (rows[1].phones, rows[1].emails, rows[1].kpp, rows[1].registry_status, rows[0].registry_status) == ("1\n2", "z@b.ru\na@b.ru", "1\n2", "PENDING", "NO_INN")
    assert rows[0].phones is None and rows[0].part == 0
    assert [r.company_id for r in report.registry_report(master, sort_by=[("name", "DESC")], limit=2).collect()] == [1, 2]
    assert report.with_headers(report.registry_report(master)).columns == report.REPORT_HEADERS
    assert len(sort_columns([("nope", "ASC")], ["name"], "name")) == 1


def test_report_keeps_every_value_of_a_hot_company(spark):
    one = master_of(spark, [(1, None, "А", None, "Работает", "2024-01-01"), (2, None, "Б", None, "Работает", "2024-01-01")])
    many = spark.range(1000).selectExpr("1L company_id", "concat('http://c/x', id) source_url", "'s' site_key", "'2024-01-01' first_seen_at", "'2024-01-01' last_seen_at")
    master = one.with_tables(sources=one.sources.unionByName(many))
    rows = report.registry_report(master, cell_values=50).collect()
    parts = [r.sources.split("\n") for r in rows if r.company_id == 1]
    assert sorted(sum(parts, [])) == sorted([f"http://c/x{i}" for i in range(1000)] + ["http://c/1"])
    assert len(parts) > 15 and max(map(len, parts)) < 120 and len([r for r in rows if r.company_id == 2]) == 1
    whole = next(r.sources for r in report.registry_report(master).collect() if r.company_id == 1)
    assert sum(parts, []) == whole.split("\n")  # parts put one after another are the one cell


def test_report_sink(spark, tmp_path):
    master = master_of(spark, [(1, "0770000001", 'А "Б"\nв', None, "Работает", "2024-01-01")])
    rows = report.registry_report(master)
    assert registry.write_report(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv")).first()
    assert (back.inn, back.name) == ("0770000001", 'А "Б"\nв')
    assert not registry.write_report(rows.filter("company_id < 0"), str(tmp_path / "none"), "parquet")
    assert not (tmp_path / "none").exists()


def test_store(spark):
    store = registry.RegistryStore(spark, new_folder(spark, "store"))
    assert store.read().companies.isEmpty() and store.last_commit() is None
    first = upsert.upsert_batch(frame(spark, [listing(1, inn="7700000001")]), store.read())
    store.write(first, 0)
    second = upsert.upsert_batch(frame(spark, [listing(2, inn="7700000002")]), store.read())
    store.write(second, 1)
    store.write(first, 1)
    assert store.last_commit()["version"] == 2 and store.read().companies.count() == 2
    with pytest.raises(ValueError):
        store.write(Master(first.companies.drop("inn"), first.sources, first.contacts, first.kpp), 2)
    assert store.read().companies.count() == 2


# --- Streams ---------------------------------------------------------------------------


def test_stream_frontier(spark):
    inbox, folder, progress = (new_folder(spark, n) for n in ("inbox", "frontier", "progress"))
    log = outcomes(spark, LOG)
    for part in ("event_id < 5", "event_id >= 4"):
        log.filter(part).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(log.schema).parquet(inbox)
        sf.start_frontier(stream, folder, progress).awaitTermination()
    want = {tuple(r) for r in frontier.fold_outcomes(log).collect()}
    assert {tuple(r) for r in sf.read_frontier(spark, folder).collect()} == want
    sf.frontier_sink(folder)(log.filter("event_id < 5"), 0)
    assert {tuple(r) for r in sf.read_frontier(spark, folder).collect()} == want
    compacted = new_folder(spark, "compacted")
    sf.compact_frontier(spark, folder, compacted)
    assert {tuple(r) for r in sf.read_frontier(spark, compacted).collect()} == want
    assert sf.read_frontier(spark, new_folder(spark, "none")).isEmpty()


def test_late_and_repeated_outcomes_count_once(spark):
    """A row 30 days late is folded in, and a failure that is delivered three times counts once."""
    folder = new_folder(spark, "frontier")
    rows = [("u1", "s", 10, "2024-03-01 00:00:00", "failed", 0.1), ("u2", "s", 11, "2024-03-01 00:00:00", "discovered", 0.1),
            ("u2", "s", 3, "2024-01-30 00:00:00", "completed", 0.1)]
    log = spark.createDataFrame(rows, "url string, site_key string, event_id long, ts string, outcome string, response_sec double")
    for batch, keep in enumerate(("event_id = 10", "event_id > 9", "event_id < 4", "event_id = 10")):
        sf.frontier_sink(folder)(log.filter(keep), batch)
    got = {r.url: (r.status, r.attempts) for r in sf.read_frontier(spark, folder).collect()}
    assert got == {"u1": ("pending", 1), "u2": ("completed", 0)}


def test_stream_upsert_replay(spark):
    store = registry.RegistryStore(spark, new_folder(spark, "registry"))
    inbox, progress = new_folder(spark, "inbox"), new_folder(spark, "progress")
    rows = [listing(1, inn="7700000001", website="HTTP://a.ru"), listing(2, website="www.a.ru", scrape_date="2024-07-07")]
    for row in rows:
        spark.createDataFrame([tuple(row[f.name] for f in LISTINGS)], LISTINGS).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(LISTINGS).parquet(inbox)
        su.start_upsert(stream, store, progress).awaitTermination()
    r = store.read().companies.collect()
    assert [(c.company_id, c.inn, c.website, c.scrape_date) for c in r] == [(1, "7700000001", "a.ru", "2024-07-07")]
    su.upsert_sink(store, progress)(frame(spark, rows[:1]), 0)
    assert store.last_commit()["version"] == 2
    # a stream with a new checkpoint counts its batches from 0 again
    other, again = new_folder(spark, "other"), new_folder(spark, "again")
    third = listing(3, website="b.ru")
    spark.createDataFrame([tuple(third[f.name] for f in LISTINGS)], LISTINGS).write.parquet(other)
    su.start_upsert(spark.readStream.schema(LISTINGS).parquet(other), store, again).awaitTermination()
    assert {c.website for c in store.read().companies.collect()} == {"a.ru", "b.ru"}


def test_batch_write_before_a_stream(spark):
    store = registry.RegistryStore(spark, new_folder(spark, "registry"))
    rows = [listing(1, website="a.ru"), listing(2, website="b.ru")]
    store.write(upsert.upsert_batch(frame(spark, rows[:1]), store.read()), batch_id=0)
    store.write(upsert.upsert_batch(frame(spark, rows[1:]), store.read()), batch_id=0)  # a replay: nothing changes
    su.upsert_sink(store, "stream")(frame(spark, rows[1:]), 0)
    assert {c.website for c in store.read().companies.collect()} == {"a.ru", "b.ru"}


def test_two_writers_lose_nothing(spark):
    """The second writer from one base gets a conflict; ``update`` resolves its batch anew on what the first left."""
    folder = new_folder(spark, "registry")
    a, b = (registry.RegistryStore(spark, folder, buckets=4) for _ in range(2))
    a.write(upsert.upsert_batch(frame(spark, [listing(1, website="a.ru")]), a.read()), 0)
    base = a.read()
    first = upsert.upsert_changes(frame(spark, [listing(1, url="http://c/b", website="b.ru")]), base)
    a.append(*first, 1, "a")
    with pytest.raises(registry.Conflict):
        b.append(*upsert.upsert_changes(frame(spark, [listing(1, url="http://c/c", website="c.ru")]), base), 1, "b")
    with pytest.raises(registry.Conflict):
        b.write(base, 2, "b")
    with pytest.raises(registry.Conflict):
        b._commit(1, "b", 1, 9, [])  # the commit itself is refused as well
    b.update(lambda master: upsert.upsert_changes(frame(spark, [listing(1, url="http://c/c", website="c.ru")]), master), 1, "b")
    got = {c.website: c.company_id for c in a.read().companies.collect()}
    assert set(got) == {"a.ru", "b.ru", "c.ru"} and sorted(got.values()) == [1, 2, 3]
    assert a.read().version == 3 and a.last_commit()["mark"] == 3


def test_a_delta_holds_what_it_touches_and_compaction_changes_nothing(spark):
    store = registry.RegistryStore(spark, new_folder(spark, "registry"), buckets=2, deltas=1)
    rows = [listing(k, url=f"http://c/{k}", website=f"w{k}.ru", phones=[f"+7 495 111 22 {k}"], name="А") for k in range(10, 40)]
    store.write(upsert.upsert_batch(frame(spark, rows), store.read()), 0)
    again = frame(spark, [listing(50, url="http://c/10", website="w11.ru", name="Б", scrape_date="2024-12-01")])
    store.append(*upsert.upsert_changes(again, store.read()), 1)
    segments = store.last_commit()["segments"]
    delta = spark.read.parquet(f"{segments[-1]['folder']}/companies")
    assert {r.company_id for r in delta.collect()} == {10, 11} and len(segments) == 2  # the site's company and the address's owner
    before = {n: {tuple(r) for r in t.collect()} for n, t in store.read().all_tables().items()}
    assert store.compact() and store.due(store.last_commit()) == []
    assert {n: {tuple(r) for r in t.collect()} for n, t in store.read().all_tables().items()} == before
    assert len(before["companies"]) == 30 and {c.name for c in store.read(1).companies.collect()} == {"А"}
