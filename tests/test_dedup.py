"""The moves of both dedup passes made at once."""

import random

from pyspark.sql import functions as F

from firmament.operators import dedup
from firmament.schemas import COMPANIES, DATES, MASTER_TABLES, Master


def random_master(spark, seed, n=60):
    draw = random.Random(seed)
    day = lambda: f"2024-01-{draw.randint(1, 28):02d}"
    some = lambda *values: draw.choice([None, *values])
    companies, dates, contacts, kpp, sources = [], [], [], [], []
    for i in range(1, n + 1):
        known = {"company_id": i, "inn": some("1", "2", "3"), "name": some("Alfa", "Beta", "\"Alfa\"", "Gamma"), "website": some(*[f"w{k}.ru" for k in range(12)]),
                 "address": some("a", "b"), "director": some("x", "y"), "ogrn": some("o1", "o2"), "status_aggregator": draw.choice(["Работает", "закрыто"]),
                 "first_seen_at": draw.choice(["", day()]), "last_seen_at": day(), "scrape_date": day()}
        companies.append(tuple(known.get(c) for c in COMPANIES.names))
        dates.append(tuple(i if c == "company_id" else some(day()) for c in DATES.names))
        for _ in range(draw.randint(0, 3)):
            phone = draw.choice(["+7 (495) 111-11-11", "8 495 222 22 22", "+7 (495) 222-22-22", "12", "+7 (812) 333-33-33"])
            contacts.append((i, "phone", phone, day(), day()))
        contacts.append((i, "email", draw.choice(["a@b.ru", "c@d.ru"]), day(), day()))
        kpp.append((i, draw.choice(["k1", "k2"]), day()))
        sources.append((i, f"http://s/{i}", "s", day(), day()))
    tables = dict(companies=companies, sources=sources, contacts=contacts, kpp=kpp)
    frames = {n: spark.createDataFrame(rows, MASTER_TABLES[n]) for n, rows in tables.items()}
    return Master(**frames, dates=spark.createDataFrame(dates, DATES))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_both_passes_at_once_give_the_rows_of_one_after_the_other(spark):
    for seed in (1, 2):
        master = random_master(spark, seed)
        both, log = dedup.dedup_pass(master)
        by_site = dedup.website_id_map(master.companies).localCheckpoint()
        first = dedup.merge_master(master, by_site)
        first = first.with_tables(**{n: t.localCheckpoint() for n, t in first.all_tables().items()})
        by_name = dedup.name_phone_id_map(first).localCheckpoint()
        second = dedup.merge_master(first, by_name)
        assert by_site.count() and by_name.count()
        for name, table in second.all_tables().items():
            assert rows_of(both.all_tables()[name]) == rows_of(table), name
        inns = dedup.merge_log(master.companies, by_site).unionByName(dedup.merge_log(first.companies, by_name))
        assert rows_of(log) == rows_of(inns)


def test_tables_that_nobody_asks_for_are_not_read(spark):
    master = random_master(spark, 3)
    broken = F.raise_error(F.lit("read"))
    master = master.with_tables(
        sources=master.sources.withColumn("site_key", broken.cast("string")),
        kpp=master.kpp.withColumn("kpp", broken.cast("string")), dates=None,
    )
    merged, log = dedup.dedup_pass(master)
    assert log.count() and merged.companies.count() and merged.contacts.count()
