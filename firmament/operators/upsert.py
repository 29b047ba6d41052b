"""Batch card upsert: assign records to companies, fold fields, upsert child tables (M1-M4).

A batch means "these cards, one after another in ``ingest_seq`` order", although all
of them are resolved at once:

* A record follows the first cascade level on which some company held its key when it
  arrived, and there the oldest such company.  That gives every record at most one
  parent, and pointer chasing turns parents into companies.
* A record without a parent founds a company.  Its ``ingest_seq`` becomes the ``company_id``,
  unless a company has or had that id, or an earlier founder of the batch takes it: then the next
  number above all ids given so far does, in the order of arrival.  So ids are stable over
  re-runs and never clash, whatever numbers the records come with.
* A company holds its first inn, its first website and its source addresses for good, a
  name with each of its phones while that is its current name, and it is open for a
  foreign inn until it has one.  All this follows from the company's earlier records, so
  the step is repeated with the companies found until none changes.  It starts from a guess:
  a record follows the first that came with its key, or a known company that holds it.

A decision depends on earlier records only.  Hence every round settles at least the
earliest record that is not settled yet, there is one fixpoint whatever the guess was, and the rounds end there;
a company that merges into another over a chain of keys takes a round per link.  What a company holds follows
from its own records, so a later round works out again only companies that records left or entered, and only
records with a key that such a company holds or held.

Arrivals are numbered without gaps first, over ranges of a sample's quantiles, so slices of
them hold equal numbers of records whatever ``ingest_seq`` looks like; records of one number
follow their address, then a hash of the whole record.  Only narrow key rows take part;
afterwards one aggregation per table folds existing and new values.  Every fresh field keeps the
scrape date it came with, so folding in several batches gives what folding in one does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmament.functions import normalize as N
from firmament.operators import children as C
from firmament.operators.graph import chase_pointers
from firmament.operators.match import (
    INN,
    LEVELS,
    NAME_PHONE,
    SOURCE,
    WEBSITE,
    company_keys,
    explode_keys,
    key_record,
    name_phone_key,
)
from firmament.schemas import COMPANIES, DATES, FRESH, IMMUTABLE, OFFICIAL, Master, dated_companies
from firmament.session import cut, stored

NEVER = 2**62
KNOWN_SEQ = -1

# Inside this module known companies carry their id minus OFFSET: negative, hence
# older than any company the batch founds.
OFFSET = 2**62

# What a company's records say besides the keys of ``LEVELS``.
NAME, PHONE = 5, 6

# A key behind its hash: sorts compare eight bytes first, which the text of keys has mostly in common.
KEY = ["hashed", "level", "key"]

# Records per slice of arrivals: the size a key's running minimum is worked in.
SLICE = 1_000_000


@dataclass(frozen=True)
class Slices:
    """Arrivals 0 to ``records`` - 1 in stretches of ``SLICE``."""

    records: int

    def number(self, arrival: Column) -> Column:
        return F.greatest(F.floor(arrival / F.lit(SLICE)), F.lit(0))

    @property
    def levels(self) -> int:
        """Halvings that cut all arrivals down to one."""
        return max(1, self.records).bit_length()


def hashed(keys: DataFrame) -> DataFrame:
    return keys.withColumn("hashed", F.xxhash64("level", "key"))


def unchanged(rows: DataFrame) -> DataFrame:
    return rows


def numbered(rows: DataFrame, order: list[str], name: str, finish: Callable = unchanged) -> tuple[DataFrame, int]:
    """Rows with ``name``, their place in that order from 0 on, and how many there are.

    The columns of ``order`` tell all rows apart.  ``finish`` derives costly columns of rows that lie in order:
    what stands in ``rows`` is worked out twice, as ranges are taken from a sample.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The generated id holds the partition above 33 bits and the place in it below.
    ranged = finish(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    ranged = cut(ranged.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    sizes = sorted(tuple(r) for r in ranged.groupBy("_part").count().collect())  # a row per partition
    bases, total = [], 0
    for part, size in sizes:
        bases.append((part, total))
        total += size
    before = F.broadcast(spark.createDataFrame(bases, "_part bigint, _base bigint"))
    nth = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return ranged.join(before, "_part").withColumn(name, F.col("_base") + nth).drop("_part", "_base", "_id"), total


def mark_rows(listings: DataFrame) -> DataFrame:
    """Records with an identity (``row_id``) and a hash that orders those of one number and address (``tie``).

    They are materialised: a batch is read for its keys and again for every table, behind
    it may lie the parsing of pages, and row ids hold for stored rows only.
    """
    return cut(listings.withColumns({"row_id": F.monotonically_increasing_id(), "tie": F.xxhash64(*listings.columns)}))


def number_arrivals(records: DataFrame, finish: Callable = unchanged) -> tuple[DataFrame, int]:
    """Records with ``seq``, their place in the order of arrival from 0 on, and how many there are."""
    order = [c for c in ("ingest_seq", "source_url", "tie", "row_id") if c in records.columns]
    return numbered(records, order, "seq", finish)


def known_code(company_id: Column) -> Column:
    return company_id - F.lit(OFFSET)


def company_of(code: Column) -> Column:
    return F.when(code < 0, code + F.lit(OFFSET)).otherwise(code)


def known_offers(wanted: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """``(level, key, company_id, has_inn)``: known holders of wanted keys, on the name-and-phone level all
    of them, elsewhere the oldest, as nothing takes those keys away.

    Held keys are dealt once, as they are grouped by the columns of the join; wanted keys that come hashed
    have a row each.
    """
    asked = wanted.select(*KEY) if "hashed" in wanted.columns else hashed(wanted.select("level", "key").distinct())
    held = hashed(company_keys(master, unify_prefix)).join(asked, KEY, "left_semi")
    soft = F.col("level") == NAME_PHONE
    oldest = held.filter(~soft).groupBy(*KEY).agg(
        F.min("company_id").alias("company_id"), F.lit(None).cast("boolean").alias("has_inn")
    )
    named = held.filter(soft).select(*KEY, "company_id", "has_inn").distinct()
    return oldest.unionByName(named).drop("hashed").withColumn("company_id", known_code(F.col("company_id")))


def known_members(offers: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """Known companies the batch may touch, in the shape of key records that came before it.

    One row has the company's own fields, further rows one phone each.
    """
    touched = offers.select(company_of(F.col("company_id")).alias("company_id")).distinct()
    companies = dated_companies(master.companies.join(touched, "company_id", "left_semi"), master.dates).select(
        "company_id", "inn", "website", F.when(F.col("name") != "", N.normalize_name("name")).alias("name_norm"),
        F.col("name_date").alias("scrape_date"), F.array().cast("array<string>").alias("fps"),
    )
    nothing = F.lit(None).cast("string")
    phones = (
        master.contacts.filter(F.col("contact_type") == "phone")
        .select("company_id", N.phone_fingerprint("value", unify_prefix).alias("fp"))
        .filter(N.usable_fingerprint(F.col("fp")))
        .join(touched, "company_id", "left_semi")
        .select("company_id", nothing.alias("inn"), nothing.alias("website"), nothing.alias("name_norm"),
                nothing.alias("scrape_date"), F.array("fp").alias("fps"))
    )
    return companies.unionByName(phones).select(
        known_code(F.col("company_id")).alias("company_id"), F.lit(KNOWN_SEQ).cast("bigint").alias("seq"), "inn", "website",
        F.lit(None).cast("string").alias("source_url"), "name_norm", "scrape_date", "fps",
    )


def company_traits(rows: DataFrame) -> DataFrame:
    """``(company_id, kind, value, heard)``: what the records of a company say, and the first arrival that said it."""

    def said(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    fields = [(INN, "inn"), (WEBSITE, "website"), (SOURCE, "source_url"), (NAME, "name_norm")]
    phones = F.transform("fps", lambda fp: said(PHONE, fp))
    each = rows.select("company_id", "seq", F.inline(F.concat(F.array(*[said(k, F.col(c)) for k, c in fields]), phones)))
    return each.filter(F.col("value").isNotNull()).groupBy("company_id", "kind", "value").agg(F.min("seq").alias("heard"))


def running(rows: DataFrame, group: list[str], value: Column, later: bool, slices: Slices) -> DataFrame:
    """Rows with ``run``: the greatest value of a group's earlier rows, or the least of its later ones.

    Worked in slices of arrivals: inside a slice over its rows, across slices over one
    value each, so a group that holds a third of all records is no single task.
    """
    best = F.min if later else F.max
    edge = (1, Window.unboundedFollowing) if later else (Window.unboundedPreceding, -1)
    sliced = rows.withColumn("slice", slices.number(F.col("seq"))).withColumn("value", value)
    inside = Window.partitionBy(*group, "slice").orderBy("seq").rowsBetween(*edge)
    across = Window.partitionBy(*group).orderBy("slice").rowsBetween(*edge)
    outer = sliced.groupBy(*group, "slice").agg(best("value").alias("own")).select(
        *group, "slice", best("own").over(across).alias("outer")
    )
    pick = F.least if later else F.greatest
    return (
        sliced.withColumn("near", best("value").over(inside)).join(outer, [*group, "slice"])
        .withColumn("run", pick("near", "outer")).drop("slice", "value", "near", "outer")
    )


def held_names(traits: DataFrame, rows: DataFrame, slices: Slices) -> DataFrame:
    """``(company_id, name_norm, since, until)``: from which arrival to which a name is a company's current one.

    A record's name replaces another one unless that came with a newer scrape date.
    """
    spans = cut(traits.filter(F.col("kind") == NAME).groupBy("company_id").agg(
        F.min("value").alias("name_norm"), F.min("heard").alias("since"), F.count("*").alias("names")
    ))
    lasting = spans.filter("names = 1").select("company_id", "name_norm", "since", F.lit(NEVER).alias("until"))
    several = spans.filter("names > 1").select("company_id")
    if several.isEmpty():
        return lasting
    renamed = rows.filter(F.col("name_norm").isNotNull()).join(several, "company_id").select(
        "company_id", "seq", "name_norm", F.coalesce("scrape_date", F.lit("")).alias("dated")
    )
    setting = running(renamed, ["company_id"], F.col("dated"), False, slices).filter(
        F.col("run").isNull() | (F.col("dated") >= F.col("run"))
    )
    following = running(setting.drop("run"), ["company_id"], F.col("seq"), True, slices)
    return lasting.unionByName(following.select(
        "company_id", "name_norm", F.col("seq").alias("since"), F.coalesce("run", F.lit(NEVER)).alias("until")
    ))


def key_offers(rows: DataFrame, known: DataFrame, slices: Slices) -> DataFrame:
    """``(level, key, company_id, since, until, inn_since)``: held keys of batch and known companies.

    A company holds a key for arrivals after ``since`` and up to ``until``.
    """
    traits = cut(company_traits(rows))
    marks = traits.filter(F.col("kind").isin(INN, WEBSITE)).groupBy("company_id", "kind").agg(
        F.min(F.struct("heard", "value")).alias("first")
    ).select("company_id", F.col("kind").alias("level"), F.col("first.value").alias("key"), F.col("first.heard").alias("since"))
    sources = traits.filter(F.col("kind") == SOURCE).select(
        "company_id", F.lit(SOURCE).alias("level"), F.col("value").alias("key"), F.col("heard").alias("since")
    )
    before = F.lit(KNOWN_SEQ).cast("bigint").alias("since")
    hard = (
        marks.filter(F.col("key") != "").unionByName(sources)
        .unionByName(known.filter(F.col("level") != NAME_PHONE).select("company_id", "level", "key", before))
    )
    never = F.lit(NEVER)
    phones = traits.filter(F.col("kind") == PHONE).select("company_id", F.col("value").alias("fp"), "heard")
    inns = marks.filter(F.col("level") == INN).select("company_id", F.col("since").alias("inn_since"))
    soft = held_names(traits, rows, slices).join(phones, "company_id").join(inns, "company_id", "left").select(
        "company_id", F.lit(NAME_PHONE).alias("level"), name_phone_key(F.col("name_norm"), F.col("fp")).alias("key"),
        F.greatest("since", "heard").alias("since"), "until", F.coalesce("inn_since", never).alias("inn_since"),
    ).filter("since < until")
    return hard.withColumns({"until": never, "inn_since": never}).unionByName(soft)


def oldest_holders(wanted: DataFrame, offers: DataFrame, slices: Slices) -> DataFrame:
    """Oldest company that held a wanted key before the record arrived, of those that never lose it.

    A running minimum over the arrivals of a key, taken in slices: inside a slice
    over its rows, across slices over one minimum each.  So a key that a third of
    all records share is still worked on in bounded groups.
    """
    none = F.lit(None).cast("bigint")
    events = offers.select(
        "guarded", "level", "key", F.col("since").alias("at"), F.lit(1).alias("side"), F.col("company_id").alias("holder"),
        none.alias("seq"),
    ).unionByName(
        wanted.select("guarded", "level", "key", F.col("seq").alias("at"), F.lit(0).alias("side"), none.alias("holder"), "seq")
    )
    group = ["guarded", "level", "key", "slice"]
    events = events.withColumn("slice", slices.number(F.col("at")))
    inside = Window.partitionBy(*group).orderBy("at", "side").rowsBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.min("holder").over(inside)).filter(F.col("side") == 0)
    before = Window.partitionBy(*group[:3]).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        events.groupBy(*group)
        .agg(F.min("holder").alias("low"))
        .select(*group, F.min("low").over(before).alias("earlier"))
        .filter(F.col("earlier").isNotNull())
    )
    return near.join(earlier, group, "left").select("seq", "level", F.least("near", "earlier").alias("holder"))


def passing_holders(wanted: DataFrame, offers: DataFrame, slices: Slices) -> DataFrame:
    """Oldest company that held a wanted key when the record arrived, of those that lose it again.

    The arrivals for which a key is held are a range, and a range falls into a few halves,
    quarters, eighths ... of all arrivals, two of a size at most.  A record lies in one
    piece of each size, so this is an equal join on pieces with one minimum each.
    """
    size = F.explode(F.sequence(F.lit(0), F.lit(slices.levels))).alias("size")
    group = ["guarded", "level", "key", "size", "piece"]
    last = F.least(F.col("until") + 1, F.lit(slices.records))
    ranges = offers.select("guarded", "level", "key", "company_id", (F.col("since") + 1).alias("first"), last.alias("last"), size).select(
        "guarded", "level", "key", "company_id", "size",
        F.expr("shiftright(first + shiftleft(1L, size) - 1, size)").alias("low"), F.expr("shiftright(last, size)").alias("high"),
    ).filter("low < high")
    left = F.when(F.col("low") % 2 == 1, F.col("low"))
    right = F.when(F.col("high") % 2 == 1, F.col("high") - 1)
    pieces = ranges.withColumn("piece", F.explode(F.array_compact(F.array(left, right)))).groupBy(*group).agg(
        F.min("company_id").alias("holder")
    )
    concerned = wanted.join(offers.select("guarded", "level", "key").distinct(), ["guarded", "level", "key"], "left_semi")
    places = concerned.select("guarded", "level", "key", "seq", size).withColumn("piece", F.expr("shiftright(seq, size)"))
    return places.join(pieces, group).groupBy("seq", "level").agg(F.min("holder").alias("holder"))


def followed(found: DataFrame, records: DataFrame) -> DataFrame:
    """``(node, root, parent)`` of all records from ``found(seq, level, holder)``: the holder on the first level that has one."""
    levels = list(LEVELS.values())
    none = F.lit(None).cast("bigint")
    # Plain minima per level aggregate by hash and combine before the shuffle.
    hits = found.unionByName(records.select("seq", F.lit(SOURCE).alias("level"), none.alias("holder"))).groupBy("seq").agg(
        *[F.min(F.when(F.col("level") == n, F.col("holder"))).alias(f"holder_{n}") for n in levels]
    )
    holder = F.coalesce(*[F.col(f"holder_{n}") for n in levels])
    return hits.select(
        F.col("seq").alias("node"),
        F.when(holder.isNull(), F.col("seq")).when(holder < 0, holder).alias("root"),
        F.when(holder >= 0, holder).alias("parent"),
    )


def parent_pointers(wanted: DataFrame, offers: DataFrame, slices: Slices, records: DataFrame | None = None) -> DataFrame:
    """``(node, root, parent)``: the known company or the founding record a record follows.

    A record with an inn is guarded on the name-and-phone level: it may only follow a
    company that has none yet.  Most keys have one row that answers all records: the oldest of those that
    keep the key was the first of them as well, and at most one company loses it.  Arrivals are compared
    one with another only under the other keys.  ``records`` names the records if ``wanted`` has not all.
    """
    soft = F.col("level") == NAME_PHONE
    asked = hashed(wanted.withColumn("guarded", soft & F.col("has_inn")))
    given = hashed(offers.withColumn("guarded", F.lit(False)).unionByName(
        offers.filter(soft).withColumn("guarded", F.lit(True)).withColumn("until", F.least("until", "inn_since")).filter("since < until")
    ))
    key = [*KEY, "guarded"]
    lasts = F.col("until") == NEVER
    index = cut(given.groupBy(*key).agg(
        F.min(F.when(lasts, F.struct("company_id", "since"))).alias("oldest"), F.min(F.when(lasts, F.col("since"))).alias("earliest"),
        F.count_if(~lasts).alias("passing"), F.min(F.when(~lasts, F.col("company_id"))).alias("passer"),
        F.min(F.when(~lasts, F.col("since"))).alias("gained"), F.max(F.when(~lasts, F.col("until"))).alias("lost"),
    ))
    contested, crowded = F.col("oldest.since") > F.col("earliest"), F.col("passing") > 1
    keeper = F.when(~contested & (F.col("seq") > F.col("earliest")), F.col("oldest.company_id"))
    passer = F.when((F.col("passing") == 1) & (F.col("seq") > F.col("gained")) & (F.col("seq") <= F.col("lost")), F.col("passer"))
    found = asked.join(index, key).select("seq", "level", F.least(keeper, passer).alias("holder")).filter(F.col("holder").isNotNull())
    for hard, side, holders in ((contested, lasts, oldest_holders), (crowded, ~lasts, passing_holders)):
        keys = index.filter(hard).select(*key)
        if not keys.isEmpty():
            concerned = (df.join(keys, key, "left_semi").drop("hashed") for df in (asked, given.filter(side)))
            found = found.unionByName(holders(*concerned, slices))
    return followed(found, wanted if records is None else records)


def first_guess(asked: DataFrame, records: DataFrame, master: Master, unify_prefix: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The keys that matter, the known holders of them, and pointers to start from.

    An inn, a website or an address that one record has and no known company is never found again.
    """
    soft = F.col("level") == NAME_PHONE
    keys = cut(hashed(asked).groupBy(*KEY).agg(
        F.count("*").alias("n"), F.min("seq").alias("first"), F.min(F.when(~F.col("has_inn"), F.col("seq"))).alias("first_open")
    ))
    known = cut(known_offers(keys, master, unify_prefix))
    code = F.col("company_id")
    met = hashed(known).groupBy(*KEY).agg(F.min(code).alias("met"), F.min(F.when(~F.col("has_inn"), code)).alias("met_open"))
    index = keys.join(met, KEY, "left").filter(soft | (F.col("n") > 1) | F.col("met").isNotNull())

    def before(first):
        return F.when(F.col(first) < F.col("seq"), F.col(first))

    holder = F.when(soft & F.col("has_inn"), F.least("met_open", before("first_open"))).otherwise(F.least("met", before("first")))
    wanted = cut(hashed(asked).join(index, KEY).select("seq", "has_inn", "level", "key", holder.alias("holder")))
    return wanted.drop("holder"), known, followed(wanted.select("seq", "level", "holder"), records)


def companies_of(pointers: DataFrame) -> DataFrame:
    return chase_pointers(pointers).select(F.col("node").alias("seq"), F.col("root").alias("company_id"))


def founder_ids(founders: DataFrame, master: Master) -> DataFrame:
    """``(company_id, founder)``: the id of every company that ``founders(seq, ingest_seq)`` found, by arrival.

    A number that is free stays, given to the first who comes with it; the others get the next ones
    above every id given so far.
    """
    used = master.companies.select(F.col("company_id").alias("ingest_seq"))
    if master.retired is not None:
        used = used.unionByName(master.retired.select(F.col("company_id").alias("ingest_seq")))
    first = founders.groupBy("ingest_seq").agg(F.min("seq").alias("seq"))
    free = first.join(used, "ingest_seq", "left_anti")
    others = founders.join(free.select("seq"), "seq", "left_anti")
    kept = founders.select(F.col("seq").alias("company_id"), F.col("ingest_seq").alias("founder"))
    if others.isEmpty():
        return kept
    others, _ = numbered(others.select("seq"), ["seq"], "nth")
    tops = used.unionByName(founders.select("ingest_seq")).agg(F.max("ingest_seq").alias("top")).head()["top"]
    top = max(tops, master.mark)
    moved = others.select(F.col("seq").alias("company_id"), (F.lit(top) + 1 + F.col("nth")).alias("founder"))
    return kept.join(moved, "company_id", "left_anti").unionByName(moved)


def assign_rows(marked: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """``(row_id, seq, company_id)`` for every record of a batch that ``mark_rows`` has marked."""
    given = marked.select("row_id", "tie", "ingest_seq", "source_url", "inn", "website", "scrape_date", "name", "phones")
    records, count = number_arrivals(given, lambda rows: key_record(rows, unify_prefix))
    slices = Slices(count)
    wanted, known, guess = first_guess(cut(explode_keys(records, "seq")), records, master, unify_prefix)
    members = cut(known_members(known, master, unify_prefix))
    shared = wanted.filter(F.col("level") == SOURCE).select("seq", F.col("key").alias("source_url"))
    fields = records.select("seq", "inn", "website", "name_norm", "scrape_date", "fps").join(shared, "seq", "left")
    assigned = companies_of(stored(guess))
    rows = cut(fields.join(assigned, "seq").unionByName(members))
    offers = cut(key_offers(rows, known, slices))
    pointers = stored(parent_pointers(wanted, offers, slices, records))
    following = companies_of(pointers)
    while not _same_companies(assigned, following):
        moved = stored(_moves(assigned, following).select(F.explode(F.array("company_id", "other_id")).alias("company_id")).distinct())
        assigned = following
        placed = stored(assigned.join(moved, "company_id", "left_semi"))
        rows = cut(fields.join(placed, "seq").unionByName(members.join(moved, "company_id", "left_semi")))
        renewed = cut(key_offers(rows, known.join(moved, "company_id", "left_semi"), slices))
        touched = offers.join(moved, "company_id", "left_semi").unionByName(renewed).select("level", "key").distinct()
        seqs = stored(wanted.join(stored(touched), ["level", "key"], "left_semi").select("seq").distinct())
        offers = cut(offers.join(moved, "company_id", "left_anti").unionByName(renewed))
        asked = stored(wanted.join(seqs, "seq", "left_semi"))
        concerned = offers.join(asked.select("level", "key").distinct(), ["level", "key"], "left_semi")
        again = stored(parent_pointers(asked, concerned, slices, seqs))
        pointers = stored(pointers.join(seqs.withColumnRenamed("seq", "node"), "node", "left_anti").unionByName(again))
        following = companies_of(pointers)
    settled = following.join(records.select("seq", "row_id", "ingest_seq"), "seq")
    ids = founder_ids(settled.filter(F.col("seq") == F.col("company_id")).select("seq", "ingest_seq"), master)
    return settled.join(ids, "company_id", "left").select(
        "row_id", "seq", F.coalesce("founder", company_of(F.col("company_id"))).alias("company_id")
    )


def assign_companies(listings: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """``(ingest_seq, source_url, company_id)`` for every record of a normalised batch.

    ``unify_prefix`` matches phones that differ in a leading 8 or 7 only.
    """
    marked = mark_rows(listings)
    found = assign_rows(marked, master, unify_prefix).select("row_id", "company_id")
    return marked.select("row_id", "ingest_seq", "source_url").join(found, "row_id").drop("row_id")


def _moves(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records with the companies they leave and enter between two assignments."""
    return a.join(b.withColumnRenamed("company_id", "other_id"), "seq").filter(F.col("company_id") != F.col("other_id"))


def _same_companies(a: DataFrame, b: DataFrame) -> bool:
    return _moves(a, b).isEmpty()


def _folded(existing: DataFrame, assigned: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Survivorship over the existing row and all assigned records of a company, with the dates of fresh fields.

    Existing values come first in arrival order.  Identifiers and website keep the
    earliest value, the fresh fields the one with the newest scrape date, status
    and dates follow the last arrival, official columns stay.
    """
    records = assigned.select(
        "company_id", *IMMUTABLE, *FRESH, "website", "status_aggregator",
        *[F.lit(None).cast("string").alias(c) for c in OFFICIAL],
        F.col("scrape_date").alias("first_seen_at"), "last_seen_at", "scrape_date",
        *[F.col("scrape_date").alias(f"{c}_date") for c in FRESH],
        F.col("ingest_seq").alias("seq"),
    )
    rows = dated_companies(existing, dates).withColumn("seq", C.before_all()).unionByName(records)

    def earliest(c):
        return F.min(F.when(F.col(c).isNotNull(), F.struct("seq", c)))[c].alias(c)

    def freshest(c):
        return F.max(F.when(F.col(c).isNotNull(), F.struct(f"{c}_date", "seq", c)))

    def latest(c):
        return F.max(F.struct("seq", c))[c].alias(c)

    return rows.groupBy("company_id").agg(
        *[earliest(c) for c in [*IMMUTABLE, "website", "first_seen_at"]],
        *[freshest(c)[c].alias(c) for c in FRESH],
        *[freshest(c)[f"{c}_date"].alias(f"{c}_date") for c in FRESH],
        *[latest(c) for c in ["status_aggregator", "last_seen_at", "scrape_date"]],
        *[F.max(c).alias(c) for c in OFFICIAL],
    )


def fold_companies(existing: DataFrame, assigned: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Company rows after a batch (M3, M4)."""
    return _folded(existing, assigned, dates).select(*COMPANIES.names)


def apply_assigned(assigned: DataFrame, master: Master) -> Master:
    """Fold records that already carry a company_id into the master."""
    return master.with_tables(
        companies=fold_companies(master.companies, assigned, master.dates),
        dates=_folded(master.companies, assigned, master.dates).select(*DATES.names),
        sources=C.upsert_sources(master.sources, C.listing_sources(assigned)),
        contacts=C.upsert_contacts(master.contacts, C.listing_contacts(assigned)),
        kpp=C.upsert_kpp(master.kpp, C.listing_kpp(assigned)),
    )


def resolved(listings: DataFrame, master: Master, unify_prefix: bool = False) -> DataFrame:
    """Records with their company; ``ingest_seq`` is their place in the batch, which no two share."""
    marked = mark_rows(listings)
    found = assign_rows(marked, master, unify_prefix)
    return cut(marked.drop("tie").join(found, "row_id").withColumn("ingest_seq", F.col("seq")).drop("row_id", "seq"))


def upsert_batch(listings: DataFrame, master: Master, unify_prefix: bool = False) -> Master:
    """Resolve a normalised batch against the master and merge it in (M2)."""
    return apply_assigned(resolved(listings, master, unify_prefix), master)


def upsert_changes(listings: DataFrame, master: Master, unify_prefix: bool = False) -> tuple[Master, DataFrame]:
    """The companies that a batch touches, as they are after it, and their ids.

    Touched are companies with a record in the batch and the owners of its source addresses.
    """
    assigned = resolved(listings, master, unify_prefix)
    owners = master.sources.join(assigned.select("source_url"), "source_url", "left_semi").select("company_id")
    touched = cut(assigned.select("company_id").unionByName(owners).distinct())
    part = master.with_tables(**{n: t.join(touched, "company_id", "left_semi") for n, t in master.all_tables().items()})
    return apply_assigned(assigned, part), touched
