import random

import pytest

from firmament.operators import children, dedup, graph, match, quality, upsert
from firmament.operators.records import normalize_listings
from firmament.schemas import LISTINGS, Master, check_master, contract_diff, empty_master
from firmament.session import cut
from tests.sequential import arrive, components


def listing(seq, url=None, **fields):
    row = {f.name: None for f in LISTINGS}
    row.update(source_url=url or f"http://c/{seq}", site_key="s", phones=[], emails=[], kpp_list=[],
               scrape_date=f"2024-01-{1 + seq % 28:02d}", ingest_seq=seq)
    row.update(fields)
    return row


def frame(spark, rows):
    return normalize_listings(spark.createDataFrame([tuple(r[f.name] for f in LISTINGS) for r in rows], LISTINGS))


def assignment(spark, rows, master=None):
    got = upsert.assign_companies(frame(spark, rows), master or empty_master(spark)).collect()
    return {r.ingest_seq: r.company_id for r in got}


def entities(seed, n_entities, n_records):
    """Records of entities that each own their inn, website, phones and names."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(n_records):
        e = 0 if rnd.random() < 0.34 else rnd.randrange(n_entities)
        rows.append(listing(
            seq, url=f"http://c/{rnd.randrange(n_records) if rnd.random() < 0.1 else seq}-{e}",
            inn=f"77{e:08d}" if rnd.random() < 0.5 else None,
            website=f"http://www.e{e}.ru/" if rnd.random() < 0.4 else None,
            name=f"Фирма {e}" if rnd.random() < 0.9 else None,
            phones=[f"+7 (495) {e:03d}-00-0{rnd.randrange(4)}"] if rnd.random() < 0.8 else [],
            address=f"адрес {seq}" if rnd.random() < 0.5 else None,
            scrape_date=f"2024-{1 + seq * 11 // n_records:02d}-{1 + rnd.randrange(28):02d}",
        ))
    return rows


@pytest.mark.parametrize("seed,slice_size", [(1, 1_000_000), (2, 30)])
def test_upsert_equals_one_by_one(spark, monkeypatch, seed, slice_size):
    """Also with slices so small that the keys of hot companies span many of them."""
    monkeypatch.setattr(upsert, "SLICE", slice_size)
    rows = entities(seed, 40, 400)
    listings = frame(spark, rows)
    plain = [r.asDict() for r in listings.collect()]
    where, companies = arrive(plain)
    assert assignment(spark, rows) == where
    master = check_master(upsert.upsert_batch(listings, empty_master(spark)))
    got = {r.company_id: r for r in master.companies.collect()}
    assert set(got) == set(companies)
    for cid, c in companies.items():
        r = got[cid]
        assert (r.inn, r.website, r.scrape_date, r.first_seen_at) == (c["inn"], c["website"], c["date"], c["first"])
    assert quality.uniqueness_violations(master).isEmpty()
    assert quality.domain_violations(master).isEmpty()
    assert quality.orphans(master).isEmpty()


def test_arrivals_are_numbered_without_gaps(spark):
    rows = entities(12, 5, 50)
    for k, r in enumerate(rows):
        r["ingest_seq"] = 10**15 if k == 49 else k * k
    numbered, count = upsert.number_arrivals(match.key_record(frame(spark, rows)))
    got = {r.ingest_seq: r.seq for r in numbered.collect()}
    assert count == 50 and [got[r["ingest_seq"]] for r in rows] == list(range(50))


def test_arrival_numbers_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(upsert, "SLICE", 20)
    rows = entities(11, 10, 90)
    for r in rows:
        r["ingest_seq"] = r["ingest_seq"] ** 2 * 1000 + 7
    where, _ = arrive([r.asDict() for r in frame(spark, rows).collect()])
    assert assignment(spark, rows) == where


def in_batches(spark, rows, cuts):
    """Companies of all records when they come in several batches."""
    master, got = empty_master(spark), {}
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        got |= assignment(spark, rows[a:b], master)
        if b < len(rows):
            master = upsert.upsert_batch(frame(spark, rows[a:b]), master)
            master = Master(**{n: cut(d) for n, d in master.tables().items()})
    return got


def one_by_one(spark, rows):
    return arrive([r.asDict() for r in frame(spark, rows).collect()])[0]


def test_two_batches_equal_one(spark):
    rows = entities(3, 30, 300)
    assert in_batches(spark, rows, [150]) == one_by_one(spark, rows)


def collisions(seed, n):
    """Records that share phones, rename companies, cross sites and bring inns late."""
    rnd = random.Random(seed)
    return [
        listing(
            seq, url=f"http://c/{rnd.randrange(n) if rnd.random() < 0.3 else 1000 + seq}",
            inn=f"77{rnd.randrange(5):08d}" if rnd.random() < 0.3 else None,
            website=f"http://w{rnd.randrange(6)}.ru" if rnd.random() < 0.35 else None,
            name="АБВГ"[rnd.randrange(4)] if rnd.random() < 0.8 else None,
            phones=[f"+7 (495) 000-00-0{rnd.randrange(4)}" for _ in range(rnd.randrange(3))],
            scrape_date=f"2024-01-{1 + seq:02d}",
        )
        for seq in range(n)
    ]


PHONE = ["+7 (495) 111-22-33"]


CASES = [
    # a company without inn takes its first claimant only
    [dict(name="А", phones=PHONE), dict(name="А", phones=PHONE, inn="7700000001"), dict(name="А", phones=PHONE, inn="7700000002")],
    # a record without inn joins the oldest company
    [dict(name="А", phones=PHONE, inn="7700000001"), dict(name="А", phones=PHONE, inn="7700000002"), dict(name="А", phones=PHONE)],
    # the claimed company got its inn over the website before
    [dict(name="А", phones=PHONE, website="a.ru"), dict(inn="7700000001", website="a.ru"), dict(name="А", phones=PHONE, inn="7700000002")],
    # different sites and different phones stay apart
    [dict(name="Тигр", phones=PHONE, website="a.ru"), dict(name="Тигр", phones=["+7 (812) 333-22-11"], website="b.ru")],
    # short numbers identify nobody
    [dict(name="А", phones=["02"]), dict(name="А", phones=["02"])],
    # of several holders of a key, one loses it to an inn that comes over its site
    [dict(name="Н", phones=PHONE), dict(name="Х", phones=["+7 (495) 222-22-33"], website="w2.ru"),
     dict(name="У", phones=["+7 (495) 333-22-33"], website="w3.ru"), dict(name="Н", phones=PHONE, website="w2.ru"),
     dict(name="Н", phones=PHONE, website="w3.ru"), dict(url="http://c/0", inn="7700000001"), dict(name="Н", phones=PHONE, inn="7700000002")],
    # a renamed company is found under its new name only
    [dict(name="Х", phones=PHONE, website="a.ru"), dict(name="У", website="a.ru"), dict(name="Х", phones=PHONE)],
    [dict(name="Х", phones=PHONE, website="a.ru"), dict(name="У", website="a.ru"), dict(name="У", phones=PHONE)],
    # a name that comes back
    [dict(name="Х", phones=PHONE, website="a.ru"), dict(name="У", website="a.ru"), dict(name="Х", website="a.ru"), dict(name="Х", phones=PHONE)],
    # a chain over three different keys
    [dict(website="a.ru", name="А"), dict(website="a.ru", inn="7700000001"), dict(inn="7700000001", name="Б", phones=PHONE), dict(name="Б", phones=PHONE)],
]
CHAIN = [dict(website="s0.ru")] + [
    fields for k in range(1, 4) for fields in (dict(website=f"s{k - 1}.ru", inn=f"77{k:08d}"), dict(inn=f"77{k:08d}", website=f"s{k}.ru"))
]


def worlds():
    """Cases, a chain of links and 50 random collections, each with keys of its own, arriving in turns."""
    own = [[listing(i, **r) for i, r in enumerate(rows)] for rows in [*CASES, CHAIN]] + [collisions(seed, 12) for seed in range(50)]
    rows = []
    for k in range(max(map(len, own))):
        for world, records in enumerate(own):
            if k < len(records):
                r = records[k]
                r["source_url"] += f"/{world}"
                r["inn"] = r["inn"] and r["inn"][:2] + f"{world:02d}" + r["inn"][4:]
                r["website"] = r["website"] and f"http://x{world}." + r["website"].removeprefix("http://")
                r["phones"] = [p.replace("(495)", f"({400 + world})").replace("(812)", f"({500 + world})") for p in r["phones"]]
                r["ingest_seq"] = len(rows)
                r["scrape_date"] = f"2024-01-{1 + k:02d}"
                rows.append(r)
    return rows


def test_collisions_in_one_batch(spark, monkeypatch):
    monkeypatch.setattr(upsert, "SLICE", 100)
    rows = worlds()
    assert assignment(spark, rows) == one_by_one(spark, rows)


def test_collisions_in_two_batches(spark):
    rows = worlds()
    assert in_batches(spark, rows, [300]) == one_by_one(spark, rows)


def small_master(spark):
    return upsert.upsert_batch(frame(spark, [
        listing(1, inn="7700000001", website="a.ru", name="А", phones=PHONE, emails=["a@a.ru"], kpp_list=["770101001"]),
        listing(2, name="Б", phones=PHONE),
    ]), empty_master(spark))


def test_match_levels(spark):
    incoming = frame(spark, [
        listing(10, inn="7700000001", website="zzz.ru"), listing(11, inn="7700000009", website="http://A.ru"),
        listing(12, url="http://c/2"), listing(13, name="«б»", phones=["8-495-111-22-33", "7 495 111 22 33"]),
        listing(14, name="а", phones=PHONE, inn="7700000009"), listing(15, name="б", phones=PHONE, inn="7700000009"),
        listing(16, name="В", phones=PHONE),
    ])
    got = {r.ingest_seq: (r.matched_level, r.company_id) for r in match.match_batch(incoming, small_master(spark)).collect()}
    assert got == {10: (1, 1), 11: (2, 1), 12: (3, 2), 13: (4, 2), 14: (None, None), 15: (4, 2), 16: (None, None)}


def test_late_record(spark):
    """An older record may not overwrite fresh fields but still sets the always-new ones."""
    master = upsert.upsert_batch(frame(spark, [
        listing(1, inn="7700000001", name="Новое", address="A", scrape_date="2024-05-05"),
        listing(2, inn="7700000001", name="Старое", director="Д", website="b.ru", scrape_date="2024-03-03", status_aggregator="Компания больше не работает"),
    ]), empty_master(spark))
    r = master.companies.first()
    assert (r.name, r.director, r.website, r.address) == ("Новое", "Д", "b.ru", "A")
    assert (r.status_aggregator, r.scrape_date, r.last_seen_at, r.first_seen_at) == (
        "Компания больше не работает", "2024-03-03", "2024-03-03", "2024-05-05")


def test_children(spark):
    again = frame(spark, [listing(20, url="http://c/1", inn="7700000001", phones=["7 495 111-22-33", "8 800 5553535"],
                                  emails=["A@a.ru", "n@a.ru"], kpp_list=["770101001", "770101002"], scrape_date="2024-09-09")])
    master = upsert.upsert_batch(again, small_master(spark))
    contacts = {(r.company_id, r.value): (r.first_seen_at, r.last_seen_at) for r in master.contacts.collect()}
    assert contacts == {
        (1, PHONE[0]): ("2024-01-02", "2024-01-02"), (1, "8 800 5553535"): ("2024-09-09", "2024-09-09"),
        (1, "a@a.ru"): ("2024-01-02", "2024-09-09"), (1, "n@a.ru"): ("2024-09-09", "2024-09-09"),
        (2, PHONE[0]): ("2024-01-03", "2024-01-03"),
    }
    assert {(r.kpp, r.first_seen_at) for r in master.kpp.collect()} == {("770101001", "2024-01-02"), ("770101002", "2024-09-09")}
    assert {(r.source_url, r.last_seen_at) for r in master.sources.collect()} == {("http://c/1", "2024-09-09"), ("http://c/2", "2024-01-03")}


def test_new_website_contacts(spark):
    found = spark.createDataFrame(
        [(1, "email", "a@a.ru"), (1, "email", "new@a.ru"), (1, "phone", "+7 (495) 111-22-33"), (1, "phone", "+7 (800) 555-35-35"), (2, "phone", "02")],
        "company_id long, contact_type string, value string",
    ).selectExpr("*", "0 pos", "'2024-09-09' seen_at", "0L ingest_seq")
    inserted = children.new_contacts(small_master(spark).contacts, found)
    assert {tuple(r) for r in children.new_contact_counts(inserted).collect()} == {(1, 1, 1)}


# --- Graph jobs ------------------------------------------------------------------


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 200)],
    [(i, (i * 7) % 90) for i in range(90)],
    [(random.Random(5).randrange(10**9) % 300 + i % 3, (i * 37) % 300) for i in range(250)],
    [(5, 5)],
])
def test_components(spark, edges):
    got = graph.connected_components(spark.createDataFrame(edges, "a long, b long"))
    expected = {k: v for k, v in components([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in got.collect()} == expected


def test_pointer_chain(spark):
    n = 300
    rows = [(0, 0, None)] + [(i, None, i - 1) for i in range(1, n)]
    got = graph.chase_pointers(spark.createDataFrame(rows, "node long, root long, parent long"))
    assert {r.node: r.root for r in got.collect()} == {i: 0 for i in range(n)}


# --- Deduplication ---------------------------------------------------------------


def master_of(spark, companies, phones=(), emails=(), kpp=()):
    """Companies as (id, inn, name, website, status, first_seen) with separate children."""
    from firmament.schemas import COMPANIES, CONTACTS, KPP, SOURCES

    rows = []
    for cid, inn, name, website, status, seen in companies:
        row = dict.fromkeys(COMPANIES.names)
        row.update(company_id=cid, inn=inn, name=name, website=website, status_aggregator=status,
                   first_seen_at=seen, last_seen_at=f"2024-02-{cid:02d}", scrape_date=f"2024-02-{cid:02d}", director=f"d{cid}")
        rows.append(tuple(row.values()))
    contacts = [(c, "phone", v, "2024-01-01", "2024-01-01") for c, v in phones] + [
        (c, "email", v, d, d) for c, v, d in emails]
    return Master(
        spark.createDataFrame(rows, COMPANIES),
        spark.createDataFrame([(c[0], f"http://c/{c[0]}", "s", "2024-01-01", "2024-01-01") for c in companies], SOURCES),
        spark.createDataFrame(contacts, CONTACTS), spark.createDataFrame(list(kpp), KPP),
    )


W, X = "Работает", "Компания больше не работает"


def test_dedup(spark):
    master = master_of(
        spark,
        [(1, None, "А", "a.ru", X, "2024-01-05"), (2, "7700000002", "А", "a.ru", X, "2024-01-03"), (3, None, "А!", None, W, "2024-01-01"),
         (4, "7700000004", "а", None, X, "2024-01-09"), (5, None, "Б", None, W, "2024-01-09"), (6, None, None, None, W, "2024-01-09"),
         (7, "7700000007", "В", "v.ru", W, "2024-01-09"), (8, "7700000008", "В", "v.ru", W, "2024-01-09")],
        phones=[(1, "+7 495 1112233"), (2, "8 800 5553535"), (3, "7-495-1112233"), (4, "88005553535"), (4, "8 800 0000000"),
                (5, "+7 495 1112233"), (6, "+7 495 1112233"), (1, "02")],
        emails=[(1, "x@a.ru", "2024-01-02"), (2, "x@a.ru", "2024-01-04"), (3, "y@a.ru", "2024-01-05")],
        kpp=[(1, "770101001", "2024-01-01"), (2, "770101001", "2024-01-02"), (4, "770101002", "2024-01-02")],
    )
    merged, log = dedup.dedup_pass(master)
    check_master(merged)
    entries = {(r.loser_id, r.winner_id, r.reason, r.loser_inn, r.winner_inn) for r in log.collect()}
    # 1 goes to 2 by website; 2 (with both phones) meets 3 and 4 by name and phone.
    assert entries == {(1, 2, "website", None, "7700000002"), (8, 7, "website", "7700000008", "7700000007"),
                       (3, 2, "name_phone", None, "7700000002"), (4, 2, "name_phone", "7700000004", "7700000002")}
    assert {tuple(r) for r in dedup.dedup_totals(log).collect()} == {("website", 2), ("name_phone", 2)}
    got = {r.company_id: r for r in merged.companies.collect()}
    assert set(got) == {2, 5, 6, 7}
    assert (got[2].inn, got[2].name, got[2].status_aggregator, got[2].first_seen_at, got[2].scrape_date, got[2].director) == (
        "7700000002", "А", W, "2024-01-01", "2024-02-02", "d2")
    contacts = {(r.contact_type, r.value, r.first_seen_at) for r in merged.contacts.collect() if r.company_id == 2}
    assert contacts == {("phone", "8 800 5553535", "2024-01-01"), ("phone", "+7 495 1112233", "2024-01-01"),
                        ("phone", "8 800 0000000", "2024-01-01"), ("email", "x@a.ru", "2024-01-04"), ("email", "y@a.ru", "2024-01-05")}
    assert {(r.company_id, r.kpp, r.first_seen_at) for r in merged.kpp.collect()} == {(2, "770101001", "2024-01-02"), (2, "770101002", "2024-01-02")}
    assert {r.company_id for r in merged.sources.collect()} == {2, 5, 6, 7}
    assert merged.sources.count() == 8
    again, second = dedup.dedup_pass(merged)
    assert second.isEmpty()
    assert {r.company_id for r in again.companies.collect()} == set(got)


def test_result_does_not_depend_on_order_or_partitions(spark):
    rows = entities(7, 25, 200)
    base = assignment(spark, rows)
    shuffled = frame(spark, random.Random(1).sample(rows, len(rows))).repartition(13)
    assert {r.ingest_seq: r.company_id for r in upsert.assign_companies(shuffled, empty_master(spark)).collect()} == base


def test_contract(spark):
    df = spark.createDataFrame([(1, "x", "y")], "company_id int, inn string, phones string")
    from firmament.schemas import COMPANIES, FORBIDDEN

    diff = contract_diff(df, COMPANIES, FORBIDDEN)
    assert "company_id is int, not bigint" in diff and "missing ogrn" in diff and "forbidden phones" in diff
    with pytest.raises(ValueError):
        check_master(empty_master(spark).with_tables(companies=df))
    assert quality.duplicate_keys(df.union(df), ["inn"], "t").first().rows == 2


# --- Options ---------------------------------------------------------------------


def test_unified_prefix(spark):
    rows = [listing(1, name="А", phones=["8 (495) 111-22-33"]), listing(2, name="А", phones=["+7 (495) 111-22-33"])]
    listings = frame(spark, rows)
    assert {r.company_id for r in upsert.assign_companies(listings, empty_master(spark), unify_prefix=True).collect()} == {1}
    master = upsert.upsert_batch(frame(spark, rows[:1]), empty_master(spark))
    for unify, want in ((False, None), (True, 1)):
        assert [r.company_id for r in match.match_batch(frame(spark, rows[1:]), master, unify_prefix=unify).collect()] == [want]


def test_compatible_inn_keeps_clusters_apart(spark):
    phones = [(i, "+7 495 1112233") for i in (1, 2, 3, 4)]
    master = master_of(spark, [(1, None, "А", None, "Работает", "2024-01-01"), (2, "7700000002", "А", None, "Работает", "2024-01-01"),
                               (3, "7700000003", "А", None, "Работает", "2024-01-01"), (4, "7700000003", "А", None, "Работает", "2024-01-01")], phones=phones)
    whole = {(r.loser_id, r.winner_id) for r in dedup.name_phone_id_map(master).collect()}
    apart = {(r.loser_id, r.winner_id) for r in dedup.name_phone_id_map(master, require_compatible_inn=True).collect()}
    assert whole == {(1, 2), (3, 2), (4, 2)} and apart == {(1, 2), (4, 3)}


def test_ids_never_clash(spark):
    """Repeated arrival numbers, numbers that start again and ids that were merged away give companies of their own."""
    rows = [listing(5, url=f"http://c/{k}", inn=f"77000000{k:02d}") for k in (3, 1, 2)] + [listing(9, inn="7700000009")]
    master = upsert.upsert_batch(frame(spark, rows), empty_master(spark))
    master = master.with_tables(**{n: cut(t) for n, t in master.all_tables().items()})
    assert {r.source_url: r.company_id for r in master.sources.collect()} == {
        "http://c/1": 5, "http://c/2": 10, "http://c/3": 11, "http://c/9": 9}
    retired = spark.createDataFrame([(20,)], "company_id bigint")
    again = frame(spark, [listing(k, url=f"http://d/{k}", inn=f"78000000{k:02d}") for k in (5, 6, 20)])
    got = {r.ingest_seq: r.company_id for r in upsert.assign_companies(again, master.with_tables(retired=retired)).collect()}
    assert got == {5: 21, 6: 6, 20: 22}
    assert {r.company_id for r in upsert.assign_companies(again, master.with_tables(mark=99)).collect()} == {100, 6, 20}


def test_fields_do_not_depend_on_the_split(spark):
    """Records with shuffled dates, folded in one batch, in two and in three, give the same companies, names and matches."""
    rows = entities(21, 3, 20)
    rnd = random.Random(4)
    for r in rows:
        r["scrape_date"] = f"2024-{rnd.randrange(1, 13):02d}-01"
    results = []
    for cuts in ([], [6, 13]):
        master = empty_master(spark)
        for a, b in zip([0, *cuts], [*cuts, 20], strict=True):
            master = upsert.upsert_batch(frame(spark, rows[a:b]), master)
            master = master.with_tables(**{n: cut(t) for n, t in master.all_tables().items()})
        results.append([{tuple(r) for r in t.collect()} for t in (master.companies, master.sources, master.dates)])
    assert results[0] == results[1]
    where, companies = one_by_one(spark, rows), arrive([r.asDict() for r in frame(spark, rows).collect()])[1]
    assert {r[0] for r in results[0][0]} == set(companies) == set(where.values())


def test_merged_fields_keep_their_dates(spark):
    master = master_of(spark, [(1, None, "А", "a.ru", "Работает", "2024-01-05"), (2, "7700000002", None, "a.ru", "Работает", "2024-01-03")])
    dates = spark.createDataFrame([(1, "2023-01-01", None, "2023-02-01", None), (2, None, None, "2023-03-01", None)],
                                  "company_id bigint, name_date string, legal_name_date string, director_date string, address_date string")
    merged, _ = dedup.dedup_pass(master.with_tables(dates=dates))
    r = merged.dates.first()
    assert (r.company_id, r.name_date, r.director_date) == (2, "2023-01-01", "2023-03-01")
    assert [r.company_id for r in merged.retired.collect()] == [1]


def test_later_rounds_work_on_what_changed(spark, monkeypatch):
    asked, whole = [], upsert.parent_pointers
    monkeypatch.setattr(upsert, "parent_pointers", lambda wanted, *rest: asked.append(wanted.count()) or whole(wanted, *rest))
    rows = [listing(i, **r) for i, r in enumerate(CHAIN)] + [listing(100 + i, inn=f"78{i // 2:08d}") for i in range(60)]
    assert assignment(spark, rows) == one_by_one(spark, rows)
    assert len(asked) > 1 and asked[0] >= 60 and max(asked[1:]) < asked[0] - 60 + 1
