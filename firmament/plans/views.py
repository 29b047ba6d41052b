"""Domain tables derived from the given tables; the SQL runs on Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament.operators.records import normalize_listings
from firmament.operators.skew import dealt
from firmament.operators.upsert import apply_assigned
from firmament.schemas import OFFICIAL, Master, empty_master
from firmament.session import cut, stored, tune

TABLES = ["nation", "customer", "orders", "events", "documents", "pages"]

# Tables whose rows go through parsing or normalisation, and how many of them one task takes.
TASK_ROWS = {"orders": 100_000, "customer": 20_000, "documents": 1_000, "pages": 1_000}
HEAVY = {"orders", "documents", "pages"}  # in every query; customers only where pages are made of them

# Company records: several listings per customer, spelling varied on purpose.
FX_LISTINGS = """
SELECT concat('http://site', CAST(o.o_orderkey % 4 AS VARCHAR(20)), '.example.net/card/', CAST(o.o_orderkey AS VARCHAR(20))) AS source_url,
       concat('site', CAST(o.o_orderkey % 4 AS VARCHAR(20))) AS site_key,
       o.o_orderkey AS ingest_seq,
       o.o_custkey AS custkey,
       CASE WHEN o.o_orderkey % 5 < 3 THEN CAST(7700000000 + o.o_custkey AS VARCHAR(20)) END AS inn,
       CASE WHEN o.o_orderkey % 2 = 0 THEN c.c_name ELSE concat('"', upper(c.c_name), '".') END AS name,
       CASE WHEN o.o_orderkey % 7 < 2 THEN concat('https://WWW.cust', CAST(o.o_custkey AS VARCHAR(20)), '.example.com/')
            WHEN o.o_orderkey % 7 < 3 THEN concat('http://cust', CAST(o.o_custkey AS VARCHAR(20)), '.example.com') END AS website,
       concat('+7 (495) ', substr(CAST(1000000 + o.o_custkey AS VARCHAR(20)), 1, 3), '-', substr(CAST(1000000 + o.o_custkey AS VARCHAR(20)), 4, 4),
              CASE WHEN o.o_orderkey % 3 = 0 THEN ' (fax)' ELSE '' END) AS phone,
       CASE WHEN o.o_orderkey % 4 = 1 THEN concat('Info', CAST(o.o_custkey AS VARCHAR(20)), '@Cust.example.org') END AS email,
       CASE WHEN o.o_orderkey % 6 = 2 THEN concat(CAST(770100000 + o.o_custkey % 900 AS VARCHAR(20)), ' / ', CAST(o.o_orderkey % 6 AS VARCHAR(20))) END AS kpp,
       n.n_name AS address,
       CASE WHEN o.o_orderkey % 9 = 0 THEN 'Компания больше не работает' ELSE 'Работает' END AS status_aggregator,
       CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR(20)) AS scrape_date
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

# The normalised form of the same records.
FX_NORMALIZED = f"""
SELECT source_url, site_key, ingest_seq, custkey, inn, name,
       regexp_replace(regexp_replace(lower(website), '^(https://)?(http://)?(www\\.)?', ''), '/+$', '') AS website,
       replace(phone, ' (fax)', '') AS phone,
       lower(email) AS email,
       split_part(kpp, ' / ', 1) AS kpp,
       address, status_aggregator, scrape_date,
       lower(replace(replace(name, '"', ''), '.', '')) AS name_norm,
       concat('7495', CAST(1000000 + custkey AS VARCHAR(20))) AS fp
  FROM ({FX_LISTINGS}) l
"""

# Fetch log of the crawler.
FX_OUTCOMES = """
SELECT concat('u', CAST(user_id AS VARCHAR(20)), '/', CAST(event_id % 7 AS VARCHAR(20))) AS url,
       concat('site', CAST(user_id % 4 AS VARCHAR(20))) AS site_key, event_id, ts,
       CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'completed' ELSE 'discovered' END AS outcome,
       value AS response_sec
  FROM events
"""

# Registry answers of two providers in their own payload formats.
_NESTED_PAYLOAD = """CASE WHEN c_custkey % 10 = 0 THEN '{"suggestions":[]}' ELSE
           concat('{"suggestions":[{"data":{"inn":"', CAST(7700000000 + c_custkey AS VARCHAR(20)),
                  '","name":{"full_with_opf":"', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('FULL ', c_name) END,
                  '","short_with_opf":"', c_name, '"},"management":{"name":"Head ', CAST(c_custkey AS VARCHAR(20)),
                  '"},"address":{"value":"', c_mktsegment, ', 1"},"state":{"status":"',
                  CASE c_custkey % 7 WHEN 0 THEN 'LIQUIDATED' WHEN 1 THEN 'BANKRUPT' WHEN 2 THEN 'REORGANIZING' WHEN 3 THEN 'OTHER' ELSE 'ACTIVE' END,
                  '","liquidation_date":', CASE WHEN c_custkey % 7 = 0 THEN CAST(1600000000000 + c_custkey * 86400000 AS VARCHAR(20)) ELSE 'null' END,
                  '}}}]}') END"""

_ROW_PAYLOAD = """concat('{"rows":[{"i":"', CAST(7700000000 + c_custkey AS VARCHAR(20)), '","n":"', c_mktsegment, ' ', c_name,
                '","g":"', CASE c_custkey % 5 WHEN 0 THEN 'ЛИКВИДАТОР: ' WHEN 1 THEN 'Конкурсный управляющий: ' WHEN 2 THEN '' ELSE 'ДИРЕКТОР: ' END,
                'Chief ', CAST(c_custkey AS VARCHAR(20)), '"',
                CASE WHEN c_custkey % 8 = 0 THEN ',"e":"17.06.2021"' ELSE '' END, '}]}')"""

FX_RESPONSES = f"""
SELECT 'A' AS provider, CAST(7700000000 + c_custkey AS VARCHAR(20)) AS inn, CAST('2024-06-01 12:00:00' AS TIMESTAMP) AS fetched_at,
       {_NESTED_PAYLOAD} AS payload
  FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT 'B' AS provider, CAST(7700000000 + c_custkey AS VARCHAR(20)) AS inn, CAST('2024-06-01 12:00:30' AS TIMESTAMP) AS fetched_at,
       {_ROW_PAYLOAD} AS payload
  FROM customer WHERE c_custkey % 3 <> 1
"""

# Several answers per provider and inn: an older one that says otherwise (some come as late as
# the newest but five days), and of every fifth customer nothing but stale ones.
FX_MANY_RESPONSES = f"""
SELECT provider, inn, fetched_at - INTERVAL 40 DAY AS fetched_at, payload FROM ({FX_RESPONSES}) a
UNION ALL
SELECT provider, inn, fetched_at - INTERVAL 5 DAY AS fetched_at,
       replace(replace(payload, 'ACTIVE', 'LIQUIDATED'), 'Director', 'Former') AS payload
  FROM ({FX_RESPONSES}) b WHERE CAST(inn AS BIGINT) % 5 <> 0
UNION ALL
SELECT provider, inn, fetched_at, payload FROM ({FX_RESPONSES}) c WHERE CAST(inn AS BIGINT) % 5 > 1
"""

# Where requests for sites ended up: the same host, with www, on a parking host, on a subdomain, elsewhere.
FX_REDIRECTS = """
SELECT page_id, concat('https://site', CAST(page_id AS VARCHAR(20)), '.example.net/') AS url,
       concat('https://', CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'www.' WHEN 2 THEN 'parked.reg.ru/' WHEN 3 THEN 'shop.' ELSE 'other.example.org/' END,
              'site', CAST(page_id AS VARCHAR(20)), '.example.net/') AS final_url,
       CASE page_id % 4 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'text/plain' END AS content_type
  FROM pages
"""

# Outgoing links of cards: wrapped, plain with a query, without a target, relative.
FX_OUTGOING = """
SELECT c_custkey AS custkey, concat('cust', CAST(c_custkey AS VARCHAR(20)), '.ru') AS label,
       CASE c_custkey % 5 WHEN 0 THEN concat('/go?url=http://cust', CAST(c_custkey AS VARCHAR(20)), '.ru/&id=1')
                          WHEN 1 THEN concat('https://cust', CAST(c_custkey AS VARCHAR(20)), '.ru/?utm=x') WHEN 2 THEN '' WHEN 3 THEN '/out/7' END AS href
  FROM customer
"""

# A settled master: one company per customer with listings.
FX_COMPANIES = f"""
SELECT min(ingest_seq) AS company_id, max(inn) AS inn,
       CASE WHEN custkey % 3 = 0 THEN concat('1027', CAST(700000000 + custkey AS VARCHAR(20))) END AS ogrn,
       CASE WHEN custkey % 4 = 0 THEN '17.06.2011' WHEN custkey % 4 = 1 THEN '2012-02-30' WHEN custkey % 4 = 2 THEN '2013-05-04' END AS registration_date,
       CASE WHEN custkey % 11 = 0 THEN NULL ELSE concat('Firm ', CAST(custkey % 700 AS VARCHAR(20))) END AS name,
       CASE WHEN custkey % 2 = 0 THEN concat('Legal ', CAST(custkey AS VARCHAR(20))) END AS legal_name,
       concat('Director ', CAST(custkey % 50 AS VARCHAR(20))) AS director,
       max(address) AS address, max(website) AS website,
       CASE WHEN custkey % 5 = 0 THEN 'Компания больше не работает' ELSE 'Работает' END AS status_aggregator,
       CASE custkey % 6 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'LIQUIDATED' WHEN 2 THEN 'BANKRUPT' END AS status_official,
       CASE WHEN custkey % 6 < 3 THEN max(inn) END AS inn_verified,
       CASE WHEN custkey % 6 < 3 THEN concat('OFFICIAL ', CAST(custkey AS VARCHAR(20))) END AS legal_name_official,
       CASE WHEN custkey % 6 < 3 THEN concat('2024-0', CAST(1 + custkey % 6 AS VARCHAR(20)), '-1', CAST(custkey % 10 AS VARCHAR(20)), ' 10:00:00') END AS official_verified_at,
       CASE WHEN custkey % 6 < 3 THEN 'A' END AS provider_name,
       CASE WHEN custkey % 6 = 1 THEN '2021-06-17' END AS liquidation_date,
       CASE WHEN custkey % 6 < 3 THEN 'Head' END AS director_official,
       CASE WHEN custkey % 6 < 2 THEN 'Street 1' END AS address_official,
       min(scrape_date) AS first_seen_at, max(scrape_date) AS last_seen_at, max(scrape_date) AS scrape_date
  FROM ({FX_NORMALIZED}) l GROUP BY custkey
"""

FX_SOURCES = f"""
SELECT f.company_id, l.source_url, l.site_key, l.scrape_date AS first_seen_at, l.scrape_date AS last_seen_at
  FROM ({FX_NORMALIZED}) l
  JOIN (SELECT o_custkey, min(o_orderkey) AS company_id FROM orders GROUP BY o_custkey) f ON f.o_custkey = l.custkey
"""

FX_CONTACTS = f"""
SELECT company_id, 'phone' AS contact_type, phone AS value, first_seen_at, first_seen_at AS last_seen_at
  FROM (SELECT min(ingest_seq) AS company_id, custkey, max(phone) AS phone, min(scrape_date) AS first_seen_at
          FROM ({FX_NORMALIZED}) l GROUP BY custkey) p WHERE custkey % 13 <> 0
UNION ALL
SELECT company_id, 'phone' AS contact_type, concat('+7 (812) ', CAST(2000000 + custkey AS VARCHAR(20))) AS value, first_seen_at, first_seen_at AS last_seen_at
  FROM (SELECT min(ingest_seq) AS company_id, custkey, min(scrape_date) AS first_seen_at
          FROM ({FX_NORMALIZED}) l GROUP BY custkey) p WHERE custkey % 4 = 0
UNION ALL
SELECT company_id, 'email' AS contact_type, email AS value, first_seen_at, first_seen_at AS last_seen_at
  FROM (SELECT min(ingest_seq) AS company_id, max(email) AS email, min(scrape_date) AS first_seen_at
          FROM ({FX_NORMALIZED}) l GROUP BY custkey) e WHERE email IS NOT NULL
"""

FX_KPP = f"""
SELECT min(ingest_seq) AS company_id, CAST(770100000 + custkey % 900 AS VARCHAR(20)) AS kpp, min(scrape_date) AS first_seen_at
  FROM ({FX_NORMALIZED}) l WHERE custkey % 2 = 0 GROUP BY custkey
UNION ALL
SELECT min(ingest_seq) AS company_id, CAST(500100000 + custkey % 900 AS VARCHAR(20)) AS kpp, min(scrape_date) AS first_seen_at
  FROM ({FX_NORMALIZED}) l WHERE custkey % 5 = 0 GROUP BY custkey
"""

# Every record as a company of its own, for deduplication.
FX_RAW_COMPANIES = f"""
SELECT ingest_seq AS company_id, inn, name, website, address, status_aggregator, scrape_date, phone, email, name_norm, fp, custkey, source_url, site_key, kpp
  FROM ({FX_NORMALIZED}) l
"""

# Repeated copies of pages: one cache entry per host, several on some days.
FX_SNAPSHOTS = """
SELECT regexp_extract(url, '//([^/?#]+)', 1) AS url, page_id,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP) + CAST(page_id AS INTEGER) * INTERVAL 7 HOUR AS fetched_at, html
  FROM pages
"""

# Listing pages of ten catalogues.
FX_CATALOG = """
SELECT concat('site', CAST(page_id % 10 AS VARCHAR(20))) AS site_key,
       CAST((page_id - page_id % 10) / 10 + 1 AS INTEGER) AS page_no, html
  FROM pages
"""

# The same pages as they land: a later fetch of every third one follows an empty answer.
FX_LANDED = f"""
SELECT site_key, page_no, site_no * 1000000 + page_no AS page_id, CAST('2024-03-02 00:00:00' AS TIMESTAMP) AS fetched_at, html, (site_no + page_no) % 3 AS delivery
  FROM (SELECT c.*, CAST(substr(site_key, 5) AS BIGINT) AS site_no FROM ({FX_CATALOG}) c) p
UNION ALL
SELECT site_key, page_no, 0 AS page_id, CAST('2024-03-01 00:00:00' AS TIMESTAMP) AS fetched_at, '' AS html, page_no % 3 AS delivery
  FROM ({FX_CATALOG}) c WHERE page_no % 3 = 0
"""

# Listing pages of the real catalogues: cards of all layouts, with words that are no cards, among other links.
FX_CATALOGUES = """
SELECT c_custkey AS custkey, CAST(c_custkey AS INTEGER) AS page_no,
       CASE c_custkey % 5 WHEN 0 THEN 'chop.moscow' WHEN 1 THEN 'prochop.ru' WHEN 2 THEN 'vsechopy-mo' WHEN 3 THEN 'vsechopy-urfo' ELSE 'russkiisoyuz' END AS site_key,
       concat('<p>', c_name, '</p><a href="/catalog/firm-', num, '/">a</a> <a href="/catalog/page/">2</a> <a href="/catalog/firm-', num, '">again</a>',
              '<a href="/catalog/city/', num, '/">deep</a><A HREF="/chops/firm-', num, '">b</A><a href="/chops/tag/">tag</a>',
              '<a class="card title wide" href="/services/', num, '/guard?from=list">c</a><a href="/services/', num, '/plain">no class</a>',
              '<a class="title" href="/about/', num, '">no service</a><a class="subtitle" href="/services/', num, '/sub">other class</a>',
              '<a href="/chop/city/">city</a><a href="/chop/firm-', num, '/">d</a><a href="">none</a>') AS html
  FROM (SELECT customer.*, CAST(c_custkey AS VARCHAR(20)) AS num FROM customer) c
"""

# Landed pages of company sites: the main page and a contact page, some on http only.
FX_SITE_PAGES = """
SELECT concat(CASE WHEN page_id % 3 = 0 THEN 'http' ELSE 'https' END, '://site', CAST(page_id AS VARCHAR(20)), '.example.net') AS url, html
  FROM pages
UNION ALL
SELECT concat(CASE WHEN page_id % 3 = 1 THEN 'http' ELSE 'https' END, '://site', CAST(page_id - 1 AS VARCHAR(20)), '.example.net/contacts') AS url, html
  FROM pages
"""

# The same pages with what the fetcher says about them: every tenth site answers with a file.
FX_FETCHED_PAGES = f"""
SELECT url, url AS final_url, CASE WHEN url LIKE '%0.example.net' THEN 'application/pdf' ELSE 'text/html' END AS content_type, html
  FROM ({FX_SITE_PAGES}) s
"""

# Companies whose sites are scanned; every seventh site never answered, every fifth company has a contact already.
FX_SCANNED = """
SELECT page_id AS company_id, concat('site', CAST(page_id AS VARCHAR(20)), CASE WHEN page_id % 7 = 0 THEN '.example.org' ELSE '.example.net' END) AS website
  FROM pages
"""

# What the cards of four sites say about the companies of the orders, field by field.
FX_CARD_FIELDS = """
SELECT o_orderkey AS ingest_seq, concat('site_', substr('abcd', CAST(o_orderkey % 4 AS INTEGER) + 1, 1)) AS rule_key,
       concat('Firm ', CAST(o_custkey AS VARCHAR(20))) AS name, concat('ООО "Legal ', CAST(o_custkey AS VARCHAR(20)), '"') AS legal_name,
       CAST(7700000000 + o_custkey AS VARCHAR(20)) AS inn, concat('1027', CAST(700000000 + o_custkey AS VARCHAR(20))) AS ogrn,
       CAST(770100000 + o_custkey % 900 AS VARCHAR(20)) AS kpp, concat('Head ', CAST(o_orderkey % 97 AS VARCHAR(20))) AS director,
       concat('Town, street ', CAST(o_orderkey % 89 AS VARCHAR(20))) AS address, concat('http://cust', CAST(o_custkey AS VARCHAR(20)), '.ru') AS website,
       concat('+7 (495) 1', CAST(100000 + o_custkey AS VARCHAR(20))) AS phone, concat('8 800 ', CAST(2000000 + o_orderkey % 1000 AS VARCHAR(20))) AS more_phone,
       concat('Mail', CAST(o_custkey AS VARCHAR(20)), '@Cust.ru') AS email, concat('0', CAST(1 + o_orderkey % 9 AS VARCHAR(20)), '.06.2011') AS registration_date,
       o_orderkey % 3 AS badge
  FROM orders
"""

# Their pages in the four layouts.
FX_CARDS = f"""
SELECT ingest_seq, rule_key, concat('http://cards.example.net/', CAST(ingest_seq AS VARCHAR(20))) AS url, CASE rule_key
  WHEN 'site_a' THEN concat('<h1>', name, ': обзор</h1>', CASE badge WHEN 0 THEN '<i class="cloze">x</i>' WHEN 1 THEN '<i class="cloze-perhaps">x</i>' ELSE '' END,
    '<span class="contakt"><strong>ИНН:</strong> 1</span><span class="contakt"><strong>ИНН:</strong> ', inn, '</span><span class="contakt"><strong>ОГРН</strong><br>', ogrn,
    '</span><span class="contakt"><strong>КПП:</strong> ', kpp, ', 500101002</span><span class="contakt"><strong>Руководитель:</strong> <a href="#">', director,
    '</a></span><span class="contakt"><strong>Дата регистрации</strong> ', registration_date, '</span><span class="contakt"><strong>Юридическое название</strong> ', legal_name,
    '</span><p class="adresch2"> <b>', address, '</b> </p><span class="telch">', phone, '</span><p class="dop-info-p">Доп. телефоны: ', more_phone,
    '</p><b class="emailchop">', email, '</b><a href="mailto:', email, '">m</a><a class="sitech" href="/go?url=', website, '&amp;x=1">s</a>')
  WHEN 'site_b' THEN concat('<h1>Portal</h1><h1 class="entry-title">', name, '</h1><span class="contakt"><strong>ИНН</strong> 999</span><div class="optionally-info"><span class="contakt">',
    legal_name, '</span><span class="contakt"><strong>ИНН</strong> ', inn, '</span><span class="contakt"><strong>ОГРН </strong> ', ogrn, '</span><span class="contakt"><strong>КПП</strong>', kpp,
    '</span><span class="contakt"><strong>Руководитель</strong> ', director, '</span></div><span class="address-text"><span>', address, '</span>.</span><span class="phone-org">', phone,
    '</span><span class="dop-phone">', more_phone, '</span><span class="dop-phone"></span><span class="company-email">', email, '</span><a href="mailto:', email,
    '">m</a><a class="web-site-org" href="', website, '">x</a>')
  WHEN 'site_c' THEN concat('<h1>', name, '</h1><div class="fields"><p><b>Адрес:</b> ', address, '</p><p><b>Владелец</b>: ', director,
    '</p></div><div class="company__param"><div class="company__label">Телефоны</div><div class="company__value"><div>', phone, '</div><div>', more_phone,
    '</div></div></div><div class="company__param"><div class="company__label">E-mail / почта</div><div class="company__value">', email,
    '</div></div><div class="company__param"><div class="company__label">Сайт</div><div class="company__value"><a href="javascript:void(0)">x</a><a href="', website,
    '">d</a></div></div><div class="text">Услуги. ИНН/КПП: ', inn, '/', kpp, ', ОГРН ', ogrn, '.</div><div class="entity-tabs">', legal_name, '</div>')
  ELSE concat('<h1 class="about__title">', name, '</h1><span class="about__address">', address, '</span><div class="about__block"><span class="about__small">Наши реквизиты</span><div>ИНН: ',
    inn, '</div><div>ОГРН: ', ogrn, '</div><div>КПП: ', kpp, '</div><div>Полное наименование: ', legal_name, '</div><div>Руководитель: ', director,
    '</div></div><div class="about__block"><span class="about__small">Прочее</span><div>ИНН: 1</div></div><ul class="about__contacts"><li><a class="about__phone" href="tel:1">', phone,
    '</a></li><li><a href="tel:', more_phone, '"></a></li><li><a href="mailto:', email, '">', email, '</a></li><li><i class="fa fa-globe"></i> <a href="', website,
    '/?utm_source=c">сайт</a></li></ul><a href="tel:000">other</a>') END AS html
  FROM ({FX_CARD_FIELDS}) f
"""

# Pages with an address in one of the forms that are no plain text; two of six forms are broken.
# With the key 0x20 the encoded form of lower-case letters is the upper-case one, of @ it is ` and of . it is chr(14).
FX_PROTECTED = """
SELECT c_custkey AS custkey, translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij') AS mark,
       concat('<p>Firm</p>', CASE c_custkey % 6
         WHEN 0 THEN concat('<a href="MAILTO:Sales', translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij'), '@firm.ru?subject=hi">m</a><a href="mailto:nothing">n</a>')
         WHEN 1 THEN concat('<span data-cfemail="20', hex(concat(translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'ABCDEFGHIJ'), '`FIRM', chr(14), 'RU')), '">x</span>')
         WHEN 2 THEN '<span data-cfemail="20zz4">x</span><span data-cfemail="2">y</span>'
         WHEN 3 THEN concat('<script type="application/ld+json">{"@type":"Org","sub":[[{"Email":" Ld', translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij'), '@Firm.ru "}]]}</script>')
         WHEN 4 THEN concat('<script type="application/ld+json">{bad, "email":"bad@firm.ru"}</script>plain', translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij'), '@firm.ru')
         ELSE concat('<script type="application/ld+json">[{"a":{"email":"deep', translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij'), '@firm.ru","n":1}},{"email":5}]</script>') END) AS html
  FROM customer
"""


def load(spark: SparkSession, sf_dir: str) -> SparkSession:
    """Register the given tables as views of the session."""
    tune(spark)
    for table in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        (spread(rows, table) if table in HEAVY else rows).createOrReplaceTempView(table)
    return spark


def deal(spark: SparkSession, table: str) -> None:
    """Deal a loaded table for a query whose rows of it are costly."""
    spread(spark.table(table), table).createOrReplaceTempView(table)


def spread(df: DataFrame, table: str) -> DataFrame:
    """Deal a table whose rows are costly to process: work for every core, and tasks that do not grow with the input.

    Splits of a file do not tell how its rows lie, as one row group is never split.
    """
    if table not in TASK_ROWS:
        return df
    return dealt(df, df.count(), TASK_ROWS[table])


def listings(spark: SparkSession) -> DataFrame:
    """Raw company records of the LISTINGS schema."""
    text = F.lit(None).cast("string")
    return spark.sql(FX_LISTINGS).select(
        "source_url", "site_key", "inn", text.alias("ogrn"), text.alias("registration_date"), "name",
        text.alias("legal_name"), text.alias("director"), "address", "website",
        F.array_compact(F.array("phone")).alias("phones"),
        F.array_compact(F.array("email")).alias("emails"),
        F.split("kpp", " / ").alias("kpp_list"),
        "status_aggregator", "scrape_date", text.alias("last_seen_at"), "ingest_seq", "custkey",
    )


def normalized(spark: SparkSession) -> DataFrame:
    return normalize_listings(listings(spark))


def outcomes(spark: SparkSession) -> DataFrame:
    return spark.sql(FX_OUTCOMES)


def responses(spark: SparkSession) -> DataFrame:
    return spark.sql(FX_RESPONSES)


def many_responses(spark: SparkSession) -> DataFrame:
    return spark.sql(FX_MANY_RESPONSES)


def master(spark: SparkSession) -> Master:
    return Master(*[spark.sql(q) for q in (FX_COMPANIES, FX_SOURCES, FX_CONTACTS, FX_KPP)])


def raw_master(spark: SparkSession) -> Master:
    """Every normalised record as its own company with its own children."""
    rows = stored(normalized(spark).withColumn("company_id", F.col("ingest_seq")))
    text = F.lit(None).cast("string")
    companies = rows.select(
        "company_id", "inn", "ogrn", "registration_date", "name", "legal_name", "director", "address",
        "website", "status_aggregator", *[text.alias(c) for c in OFFICIAL],
        F.col("scrape_date").alias("first_seen_at"), "last_seen_at", "scrape_date",
    )
    seen = [F.col("scrape_date").alias("first_seen_at"), F.col("scrape_date").alias("last_seen_at")]
    tagged = F.concat(
        F.transform("phones", lambda v: F.struct(F.lit("phone").alias("contact_type"), v.alias("value"))),
        F.transform("emails", lambda v: F.struct(F.lit("email").alias("contact_type"), v.alias("value"))),
    )
    return Master(
        companies,
        rows.select("company_id", "source_url", "site_key", *seen),
        rows.select("company_id", *seen, F.inline(tagged)).select("company_id", "contact_type", "value", "first_seen_at", "last_seen_at"),
        rows.select("company_id", F.explode("kpp_list").alias("kpp"), F.col("scrape_date").alias("first_seen_at")),
    )


def master_of(spark: SparkSession, before: str) -> Master:
    """Settled master over the records scraped before a date: one company per customer."""
    rows = cut(normalized(spark).filter(F.col("scrape_date") < before))
    founded = rows.groupBy("custkey").agg(F.min("ingest_seq").alias("company_id"))
    settled = apply_assigned(rows.join(founded, "custkey").drop("custkey"), empty_master(spark))
    # A batch reads the tax codes once, if at all.
    return Master(**{name: df if name == "kpp" else cut(df) for name, df in settled.tables().items()})


def incoming(spark: SparkSession, since: str) -> DataFrame:
    """Records scraped on or after a date."""
    return normalized(spark).filter(F.col("scrape_date") >= since).drop("custkey")
