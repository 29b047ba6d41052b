"""The registered queries as plain SQL over the given tables, for a second engine."""

from __future__ import annotations

import re

from firmament import fixed_values as fv
from firmament.plans import views
from firmament.plans.queries import AS_OF, CORPUS_DOMAINS, CORPUS_LOCALS, SPLIT_DATE

N = f"({views.FX_NORMALIZED})"
COMPANIES = f"({views.FX_COMPANIES})"
SOURCES = f"({views.FX_SOURCES})"
CONTACTS = f"({views.FX_CONTACTS})"
KPP = f"({views.FX_KPP})"
OUTCOMES = f"({views.FX_OUTCOMES})"
RESPONSES = f"({views.FX_RESPONSES})"

ACTIVE = "'Работает'"


def words(values):
    return "|".join(re.escape(v) for v in values)


def sql_list(values):
    return ", ".join(f"'{v}'" for v in values)


# --- Column expressions ---------------------------------------------------------


def valid_email(e, local_parts, domains):
    local, domain = f"split_part({e}, '@', 1)", f"split_part({e}, '@', -1)"
    return f"""CAST(regexp_matches({e}, '^[^@]+@[^@]+$') AND contains({domain}, '.') AND length({local}) <= 64
        AND length({domain}) <= 255 AND NOT regexp_matches({e}, '({words(fv.FILE_EXTENSIONS)})$')
        AND {local} NOT IN ({sql_list(local_parts)})
        AND NOT regexp_matches({domain}, '(^|\\.)({words(domains)})$') AS INTEGER)"""


def found_emails(text):
    return f"list_distinct(list_transform(regexp_extract_all({text}, '{fv.EMAIL_PATTERN}'), lambda e: lower(e)))"


def found_phones(text):
    pattern = f"(?:{'|'.join(fv.PHONE_PREFIXES)}){fv.PHONE_BODY_PATTERN}"
    bare = f"list_transform(regexp_extract_all({text}, '{pattern}'), lambda p: right(regexp_replace(p, '[^0-9]', '', 'g'), 10))"
    return (
        f"list_distinct(list_transform({bare}, lambda d: "
        r"regexp_replace(d, '^(\d{3})(\d{3})(\d{2})(\d{2})$', '+7 (\1) \2-\3-\4')))"
    )


HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"


def page_text(html):
    bare = f"regexp_replace(regexp_replace({html}, '{HIDDEN}', ' ', 'g'), '<[^>]*>', ' ', 'g')"
    return f"replace(replace({bare}, '&quot;', '\"'), '&amp;', '&')"


HREFS = f"""regexp_extract_all(regexp_replace(html, '{HIDDEN}', ' ', 'g'), '<a href="([^"]*)"', 1)"""
ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"

STATUS = """CASE WHEN status_official IS NOT NULL AND liquidation_date IS NOT NULL THEN status_official || '|' || liquidation_date
     WHEN status_official IS NOT NULL THEN status_official WHEN inn IS NULL THEN 'NO_INN' ELSE 'PENDING' END"""
LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.STATUS_LABELS.items())


def label(status):
    code = f"split_part({status}, '|', 1)"
    return (
        f"CASE {code} {LABELS} ELSE {code} END || "
        f"CASE WHEN contains({status}, '|') THEN chr(10) || split_part({status}, '|', 2) ELSE '' END"
    )


def parsed(c):
    formats = ["%Y-%m-%d", "%d.%m.%Y", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S"]
    tries = ", ".join(f"try_strptime({c}, '{f}')" for f in formats)
    return f"strftime(coalesce({tries}), '%Y-%m-%d')"


def seconds(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# --- Matching and folding -------------------------------------------------------

# One company per customer: every key of the fixture records belongs to one customer.
OLD_NEW = f"""
n AS (SELECT * FROM {N} x),
old AS (SELECT * FROM n WHERE scrape_date < '{SPLIT_DATE}'),
inc AS (SELECT * FROM n WHERE scrape_date >= '{SPLIT_DATE}'),
m AS (SELECT custkey, min(ingest_seq) AS company_id, max(inn) AS inn, max(website) AS website,
             max(name_norm) AS name_norm, max(fp) AS fp FROM old GROUP BY custkey),
ids AS (SELECT n.custkey, coalesce(max(m.company_id), min(n.ingest_seq)) AS company_id
          FROM n LEFT JOIN m ON m.custkey = n.custkey GROUP BY n.custkey)"""


def fold(rows):
    """Survivorship of rows (company_id, seq, ...) in arrival order."""
    newest = "scrape_date || lpad(CAST(seq + 1 AS VARCHAR), 14, '0')"
    return f"""SELECT company_id, arg_min(inn, seq) FILTER (inn IS NOT NULL) AS inn,
       arg_max(name, {newest}) FILTER (name IS NOT NULL) AS name,
       arg_min(website, seq) FILTER (website IS NOT NULL) AS website,
       arg_max(address, {newest}) FILTER (address IS NOT NULL) AS address,
       arg_max(status_aggregator, seq) AS status_aggregator, arg_min(first_seen_at, seq) AS first_seen_at,
       arg_max(last_seen_at, seq) AS last_seen_at, arg_max(scrape_date, seq) AS scrape_date
  FROM {rows} r GROUP BY company_id"""


def founders(which):
    """First record of every customer by number and address."""
    return f"""SELECT custkey, num, source_url FROM (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY num, source_url) AS r FROM n WHERE {which}) x
        WHERE r = 1"""


def ids_of(founders, used):
    """A free number stays with its first founder, the others follow the highest id."""
    return f"""SELECT custkey, CASE WHEN free THEN num ELSE (SELECT max(company_id) FROM (SELECT num AS company_id FROM {founders} UNION ALL {used}) t)
            + sum(CASE WHEN free THEN 0 ELSE 1 END) OVER (ORDER BY num, source_url ROWS UNBOUNDED PRECEDING) END::BIGINT AS company_id
        FROM (SELECT *, row_number() OVER (PARTITION BY num ORDER BY source_url) = 1 AND num NOT IN ({used}) AS free FROM {founders}) x"""


RECORD = "ingest_seq AS seq, inn, name, website, address, status_aggregator, scrape_date AS first_seen_at, scrape_date AS last_seen_at, scrape_date"
FOUNDED = f"(SELECT min(ingest_seq) OVER (PARTITION BY custkey) AS company_id, * FROM {N} x)"
SURVIVORS = fold(f"(SELECT company_id, {RECORD} FROM {FOUNDED} f)")


def contacts_of(rows):
    """Phones and e-mails of rows (company_id, ord, phone, email, scrape_date)."""
    return f"""
SELECT company_id, 'phone' AS contact_type, arg_min(phone, ord) AS value, arg_min(scrape_date, ord) AS first_seen_at,
       arg_min(scrape_date, ord) AS last_seen_at FROM {rows} r GROUP BY company_id
UNION ALL
SELECT company_id, 'email', email, arg_min(scrape_date, ord), arg_max(scrape_date, ord)
  FROM {rows} r WHERE email IS NOT NULL GROUP BY company_id, email"""


def kpp_of(rows):
    return f"""SELECT company_id, kpp, arg_min(scrape_date, ord) AS first_seen_at
  FROM {rows} r WHERE kpp IS NOT NULL GROUP BY company_id, kpp"""


BY_SEQ = f"(SELECT company_id, ingest_seq AS ord, phone, email, kpp, scrape_date FROM {FOUNDED} f)"
BY_BATCH = f"""(SELECT ids.company_id, CASE WHEN n.scrape_date < '{SPLIT_DATE}' THEN 0 ELSE 1000000000000 END + n.ingest_seq AS ord,
       phone, email, kpp, scrape_date FROM n JOIN ids ON ids.custkey = n.custkey)"""

RANK = "CASE WHEN inn IS NULL THEN '1' ELSE '0' END || lpad(CAST(company_id AS VARCHAR), 14, '0')"


def merged(rows, root):
    """One row per cluster, values taken in winner order."""
    def first(c):
        return f"arg_min({c}, {RANK}) FILTER ({c} IS NOT NULL) AS {c}"

    return f"""SELECT {root} AS company_id, custkey, {first('inn')}, {first('name')}, {first('website')}, {first('address')},
       CASE WHEN bool_or(status_aggregator = {ACTIVE}) THEN {ACTIVE} ELSE arg_min(status_aggregator, {RANK}) END AS status_aggregator,
       min(first_seen_at) AS first_seen_at, arg_min(last_seen_at, {RANK}) AS last_seen_at, arg_min(scrape_date, {RANK}) AS scrape_date
  FROM {rows} r GROUP BY {root}, custkey"""


# Two passes: equal website, then equal name and phone (= same customer).
DEDUP = f"""
raw AS (SELECT ingest_seq AS company_id, scrape_date AS first_seen_at, scrape_date AS last_seen_at, * FROM {N} x),
s1 AS (SELECT *, first_value(company_id) OVER (PARTITION BY coalesce(website, CAST(company_id AS VARCHAR)) ORDER BY {RANK}) AS root1 FROM raw),
m1 AS ({merged('s1', 'root1')}),
s2 AS (SELECT *, first_value(company_id) OVER (PARTITION BY custkey ORDER BY {RANK}) AS root2 FROM m1)"""

NORM_NAME = "lower(replace(replace({0}, '\"', ''), '.', ''))"

MERGE_LOG = f"""
SELECT a.company_id AS loser_id, a.root1 AS winner_id, 'website' AS reason, a.website AS key, a.inn AS loser_inn, b.inn AS winner_inn
  FROM s1 a JOIN raw b ON b.company_id = a.root1 WHERE a.company_id <> a.root1
UNION ALL
SELECT a.company_id, a.root2, 'name_phone', {NORM_NAME.format('a.name')}, a.inn, b.inn
  FROM s2 a JOIN m1 b ON b.company_id = a.root2 WHERE a.company_id <> a.root2"""


# --- Reports --------------------------------------------------------------------


def cells(contacts=CONTACTS, kpp=KPP, sources=SOURCES, kpp_separator="chr(10)", cell_values=10_000):
    values = f"""(SELECT company_id, contact_type AS kind, first_seen_at, value FROM {contacts} c
      UNION ALL SELECT company_id, 'kpp', '', kpp FROM {kpp} k
      UNION ALL SELECT company_id, 'source', first_seen_at, source_url FROM {sources} s)"""

    def cell(kind, name, separator="chr(10)"):
        return f"string_agg(value, {separator} ORDER BY first_seen_at, value) FILTER (kind = '{kind}') AS {name}"

    return f"""(SELECT company_id, part, {cell('phone', 'phones')}, {cell('email', 'emails')},
        {cell('kpp', 'kpp', kpp_separator)}, {cell('source', 'sources')}
      FROM (SELECT *, CAST((row_number() OVER (PARTITION BY company_id, kind ORDER BY first_seen_at, value) - 1) // {cell_values} AS INTEGER) AS part
              FROM {values} w) p
     GROUP BY company_id, part)"""


def report(companies=f"(SELECT * FROM {COMPANIES} x)", child_cells=None, suffix=""):
    return f"""SELECT c.company_id, coalesce(k.part, 0) AS part, c.name, {STATUS} AS registry_status, c.address, c.address_official,
       k.phones, k.emails, c.director, c.director_official, c.inn, c.ogrn, k.kpp, c.legal_name, c.legal_name_official,
       c.registration_date, c.official_verified_at, c.scrape_date, c.website, k.sources
  FROM {companies} c LEFT JOIN {child_cells or cells()} k ON k.company_id = c.company_id {suffix}"""


# --- Enrichment -----------------------------------------------------------------


def jstr(path):
    return f"json_extract_string(payload, '$.{path}')"


SUGGESTION, ROW = "suggestions[0].data", "rows[0]"
G = jstr(f"{ROW}.g")
RESULTS = f"""
SELECT inn, CASE WHEN {jstr(SUGGESTION + '.state.status')} IN ({sql_list(fv.PROVIDER_STATUSES)}) THEN {jstr(SUGGESTION + '.state.status')} ELSE 'UNKNOWN' END AS status_official,
       {jstr(SUGGESTION + '.inn')} AS inn_verified,
       coalesce(nullif({jstr(SUGGESTION + '.name.full_with_opf')}, ''), {jstr(SUGGESTION + '.name.short_with_opf')}) AS legal_name_official,
       strftime(epoch_ms(CAST({jstr(SUGGESTION + '.state.liquidation_date')} AS BIGINT)), '%Y-%m-%d') AS liquidation_date,
       {jstr(SUGGESTION + '.management.name')} AS director_official, {jstr(SUGGESTION + '.address.value')} AS address_official,
       {seconds('fetched_at')} AS verified_at, 'DaData ЕГРЮЛ' AS provider_name, 1 AS priority
  FROM {RESPONSES} r WHERE provider = 'A' AND json_array_length(payload, '$.suggestions') > 0
UNION ALL
SELECT inn, CASE WHEN {jstr(ROW + '.e')} <> '' THEN 'LIQUIDATED' WHEN contains(upper({G}), 'ЛИКВИДАТОР') THEN 'LIQUIDATING'
            WHEN contains(upper({G}), 'КОНКУРСНЫЙ УПРАВЛЯЮЩИЙ') THEN 'BANKRUPT' ELSE 'ACTIVE' END,
       {jstr(ROW + '.i')}, {jstr(ROW + '.n')},
       strftime(try_strptime({jstr(ROW + '.e')}, '%d.%m.%Y'), '%Y-%m-%d'),
       CASE WHEN contains({G}, ':') THEN trim(split_part({G}, ':', 2)) ELSE trim({G}) END, NULL,
       {seconds('fetched_at')}, 'ФНС ЕГРЮЛ (egrul.nalog.ru)', 2
  FROM {RESPONSES} r WHERE provider = 'B'"""
NEWEST_RESPONSES = f"""(SELECT provider, inn, fetched_at, payload FROM ({views.FX_MANY_RESPONSES}) m
  WHERE fetched_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY
  QUALIFY row_number() OVER (PARTITION BY provider, inn ORDER BY fetched_at DESC) = 1)"""
CHAIN = f"SELECT * EXCLUDE (priority) FROM ({RESULTS}) q QUALIFY row_number() OVER (PARTITION BY inn ORDER BY priority) = 1"
DUE = (
    "inn IS NOT NULL AND (official_verified_at IS NULL OR "
    f"CAST(official_verified_at AS TIMESTAMP) < TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY)"
)
PRIORITY = f"(status_official IS NULL) DESC, (status_aggregator <> {ACTIVE}) DESC, official_verified_at ASC NULLS FIRST, company_id"
OFFICIAL = [
    "status_official", "inn_verified", "legal_name_official", "official_verified_at",
    "provider_name", "liquidation_date", "director_official", "address_official",
]


def updated(columns, companies, due, has_official=True, chain=CHAIN):
    def pick(c):
        if c not in OFFICIAL:
            return f"c.{c}"
        new = "r.verified_at" if c == "official_verified_at" else f"r.{c}"
        old = f"c.{c}" if has_official else "NULL"
        return f"CASE WHEN r.inn IS NOT NULL THEN {new} ELSE {old} END AS {c}"

    return f"""SELECT {', '.join(pick(c) for c in columns)} FROM {companies} c
  LEFT JOIN ({chain}) r ON r.inn = c.inn AND {due}"""


# --- Frontier -------------------------------------------------------------------


def folded(rows=OUTCOMES):
    return f"""SELECT url, arg_min(site_key, event_id) AS site_key,
       CASE WHEN bool_or(outcome = 'completed') THEN 'completed' WHEN count(*) FILTER (outcome = 'failed') >= 5 THEN 'error' ELSE 'pending' END AS status,
       CAST(count(*) FILTER (outcome = 'failed') AS INTEGER) AS attempts, {seconds('max(ts)')} AS updated_at
  FROM {rows} o GROUP BY url"""


MIDDLE = "TIMESTAMP '2024-01-08 00:00:00'"
NEW_LINKS = f"""SELECT url, arg_min(site_key, event_id) AS site_key, 'pending' AS status, 0 AS attempts
  FROM {OUTCOMES} o WHERE ts >= {MIDDLE} AND url NOT IN (SELECT url FROM {OUTCOMES} p WHERE ts < {MIDDLE}) GROUP BY url"""

CATALOG = f"""
hrefs AS (SELECT site_key, page_no, unnest({HREFS}) AS href FROM ({views.FX_CATALOG}) p),
links AS (SELECT DISTINCT site_key, page_no, 'http://cards.example.net/firm/' || substr(href, 2) || '/' AS url
            FROM hrefs WHERE regexp_matches(href, '^/[a-zA-Z]+$') AND href NOT IN ('/The', '/and', '/De')),
sets AS (SELECT p.site_key, p.page_no, count(l.url) AS link_count, coalesce(string_agg(l.url, ' ' ORDER BY l.url), '') AS set_key
           FROM ({views.FX_CATALOG}) p LEFT JOIN links l ON l.site_key = p.site_key AND l.page_no = p.page_no GROUP BY 1, 2),
stops AS (SELECT site_key, min(page_no) AS stop_page
            FROM (SELECT *, min(page_no) OVER (PARTITION BY site_key, set_key) AS lowest FROM sets) q
           WHERE link_count = 0 OR page_no > lowest GROUP BY site_key),
usable AS (SELECT s.site_key, s.page_no, CAST(s.link_count AS INTEGER) AS link_count, t.stop_page FROM sets s
             LEFT JOIN stops t ON t.site_key = s.site_key WHERE t.stop_page IS NULL OR s.page_no < t.stop_page)"""

CONTACT_LINKS = f"""
sp AS ({views.FX_SITE_PAGES}),
raw_links AS (SELECT url, unnest({HREFS}) AS href, generate_subscripts({HREFS}, 1) AS i FROM sp),
wanted AS (SELECT url, {ORIGIN} || href AS link, min(i) AS i FROM raw_links
            WHERE regexp_matches(lower(href), '{fv.CONTACT_LINK_PATTERN}') GROUP BY 1, 2),
usual AS (SELECT sp.url, {ORIGIN} || f.path AS link, f.i FROM sp,
                 (VALUES {', '.join(f"('{p}', {i})" for i, p in enumerate(fv.FALLBACK_PATHS))}) f(path, i)
           WHERE sp.url NOT IN (SELECT url FROM wanted)),
clinks AS (SELECT url, link, CAST(row_number() OVER (PARTITION BY url ORDER BY i) - 1 AS INTEGER) AS pos
             FROM (SELECT * FROM wanted UNION ALL SELECT * FROM usual) u)"""

SNAPSHOTS = f"({views.FX_SNAPSHOTS})"

SCAN_PHASE = f"""WITH {CONTACT_LINKS.replace(views.FX_SITE_PAGES, f"SELECT url, html FROM ({views.FX_FETCHED_PAGES}) f WHERE content_type = 'text/html'")},
    main AS (SELECT company_id, coalesce(s.url, h.url) AS url FROM ({views.FX_SCANNED}) c
               LEFT JOIN sp s ON s.url = 'https://' || website LEFT JOIN sp h ON h.url = 'http://' || website),
    extra AS (SELECT company_id, link AS url FROM main JOIN clinks ON clinks.url = main.url JOIN sp ON sp.url = clinks.link),
    hits AS (SELECT company_id, html FROM (SELECT * FROM main UNION ALL SELECT * FROM extra) a JOIN sp ON sp.url = a.url)
    SELECT DISTINCT company_id, 'email' AS contact_type, value, '2024-06-01' AS first_seen_at
      FROM (SELECT company_id, unnest({found_emails(page_text('html'))}) AS value FROM hits) e WHERE {valid_email('value', CORPUS_LOCALS, CORPUS_DOMAINS)} = 1
    UNION SELECT DISTINCT company_id, 'phone', value, '2024-06-01' FROM (SELECT company_id, unnest({found_phones(page_text('html'))}) AS value FROM hits) p"""


def card_sql(rule):
    """Fields of the cards of one layout, which differ in what they say and how."""
    first = rule == "site_a"
    site = "website || '/'" if rule == "site_d" else "website"
    badge = f"CASE badge WHEN 0 THEN '{fv.AGGREGATOR_CLOSED}' WHEN 1 THEN '{fv.AGGREGATOR_MAYBE}' ELSE {ACTIVE} END" if first else ACTIVE
    return f"""SELECT ingest_seq, name, legal_name, inn, ogrn, {"registration_date" if first else "CAST(NULL AS VARCHAR) AS registration_date"}, director, address,
        {site} AS website, phone || ',' || more_phone AS phones, {"email" if rule == "site_c" else "lower(email)"} AS emails,
        kpp{" || ',500101002'" if first else ""} AS kpp_list, {badge} AS status_aggregator
        FROM ({views.FX_CARD_FIELDS}) f WHERE rule_key = '{rule}'"""


ORACLE = {
    "normalize_listings": f"""SELECT source_url, site_key, ingest_seq, inn, name, website, phone AS phones, coalesce(email, '') AS emails,
        coalesce(kpp, '') AS kpp_list, address, status_aggregator, scrape_date, scrape_date AS last_seen_at FROM {N} x""",
    "website_groups": f"""SELECT website, count(*) AS companies, min(ingest_seq) AS lowest_id FROM {N} x
        WHERE website IS NOT NULL GROUP BY website HAVING count(*) > 1""",
    "phone_fingerprints": f"""SELECT name_norm, fp, count(*) AS listings, min(ingest_seq) AS first_seq FROM {N} x
        GROUP BY name_norm, fp HAVING count(*) > 1""",
    "email_validity": f"""SELECT doc_id, email, {valid_email('email', fv.JUNK_LOCAL_PARTS, fv.JUNK_DOMAINS)} AS valid_default,
        {valid_email('email', CORPUS_LOCALS, CORPUS_DOMAINS)} AS valid_corpus
        FROM (SELECT doc_id, unnest({found_emails('text')}) AS email FROM documents) d""",
    "status_labels": f"""SELECT company_id, st AS registry_status, split_part(st, '|', 1) AS code, {label('st')} AS label
        FROM (SELECT company_id, {STATUS} AS st FROM {COMPANIES} c) q""",
    "date_parse": f"""SELECT company_id, {parsed('registration_date')} AS registration_date, {parsed('official_verified_at')} AS official_verified_at,
        {parsed('scrape_date')} AS scrape_date,
        CASE WHEN regexp_matches(registration_date, '^[0-9]+\\.[0-9]+\\.[0-9]+$')
             THEN split_part(registration_date, '.', 3) || '-' || split_part(registration_date, '.', 2) || '-' || split_part(registration_date, '.', 1)
             ELSE registration_date END AS registration_iso FROM {COMPANIES} c""",
    "contact_summaries": f"""SELECT ingest_seq, '[тел:1' || CASE WHEN email IS NOT NULL THEN ' email:1' ELSE '' END
        || CASE WHEN kpp IS NOT NULL THEN ' кпп:1' ELSE '' END || ']' AS summary FROM {N} x""",
    "set_ops": f"""WITH s AS (SELECT custkey, site_key, bool_or(scrape_date < '{SPLIT_DATE}') AS a, bool_or(scrape_date >= '{SPLIT_DATE}') AS b
          FROM {N} x GROUP BY 1, 2)
        SELECT custkey, string_agg(site_key, ',' ORDER BY site_key) AS either,
          coalesce(string_agg(site_key, ',' ORDER BY site_key) FILTER (a AND b), '') AS both,
          coalesce(string_agg(site_key, ',' ORDER BY site_key) FILTER (a AND NOT b), '') AS only_early,
          CAST(bool_or(a AND b) AS INTEGER) AS overlap, CAST(bool_and(a = b) AS INTEGER) AS equal FROM s GROUP BY custkey""",
    "link_resolution": f"""SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, href, {ORIGIN} || href AS resolved,
        lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS base_path,
        sha256(url) AS url_key
        FROM (SELECT page_id, url, unnest({HREFS}) AS href, generate_subscripts({HREFS}, 1) AS pos FROM pages) p""",
    "page_links": f"WITH {CATALOG} SELECT * FROM links",
    "catalog_stop": f"WITH {CATALOG} SELECT * FROM usable",
    "discovered_frontier": f"""WITH {CATALOG} SELECT url, arg_min(l.site_key, lpad(CAST(l.page_no AS VARCHAR), 9, '0') || l.site_key) AS site_key,
        'pending' AS status, 0 AS attempts FROM links l JOIN usable u ON u.site_key = l.site_key AND u.page_no = l.page_no
        WHERE url NOT IN (SELECT url FROM {OUTCOMES} o) GROUP BY url""",
    "catalogue_links": f"""SELECT site_key, page_no, CASE site_key WHEN 'chop.moscow' THEN 'https://chop.moscow/catalog/firm-' || custkey || '/'
          WHEN 'prochop.ru' THEN 'https://prochop.ru/chops/firm-' || custkey || '/'
          WHEN 'russkiisoyuz' THEN 'https://xn--g1abdcwihado2k.xn--p1ai/services/' || custkey || '/guard'
          ELSE 'https://xn--b1ag1aeh1b4a.xn--p1ai/chop/firm-' || custkey || '/' END AS url FROM ({views.FX_CATALOGUES}) c""",
    "page_emails": f"SELECT page_id, unnest({found_emails(page_text('html'))}) AS email FROM pages",
    "page_phones": f"SELECT page_id, unnest({found_phones(page_text('html'))}) AS phone FROM pages",
    "doc_contacts": f"""WITH e AS (SELECT doc_id, list_filter({found_emails('text')}, lambda e: {valid_email('e', CORPUS_LOCALS, CORPUS_DOMAINS)} = 1) AS es,
          {found_phones('text')} AS ps FROM documents)
        SELECT doc_id, array_to_string(list_sort(es), ',') AS emails, array_to_string(list_sort(ps), ',') AS phones
          FROM e WHERE len(es) > 0 OR len(ps) > 0""",
    "contact_links": f"WITH {CONTACT_LINKS} SELECT url, pos, link FROM clinks",
    "site_scan": f"""WITH {CONTACT_LINKS},
        main AS (SELECT page_id AS company_id, coalesce(s.url, h.url) AS url FROM pages
                   LEFT JOIN sp s ON s.url = 'https://site' || page_id || '.example.net'
                   LEFT JOIN sp h ON h.url = 'http://site' || page_id || '.example.net'),
        extra AS (SELECT company_id, link AS url FROM main JOIN clinks ON clinks.url = main.url JOIN sp ON sp.url = clinks.link),
        hits AS (SELECT company_id, html FROM (SELECT * FROM main UNION ALL SELECT * FROM extra) a JOIN sp ON sp.url = a.url)
        SELECT DISTINCT company_id, 'email' AS contact_type, value FROM (SELECT company_id, unnest({found_emails(page_text('html'))}) AS value FROM hits) e
         WHERE {valid_email('value', CORPUS_LOCALS, CORPUS_DOMAINS)} = 1
        UNION SELECT DISTINCT company_id, 'phone', value FROM (SELECT company_id, unnest({found_phones(page_text('html'))}) AS value FROM hits) p""",
    **{f"cards_site_{x}": card_sql(f"site_{x}") for x in "abcd"},
    "protected_contacts": f"""SELECT custkey, CASE custkey % 6 WHEN 0 THEN 'sales' WHEN 1 THEN '' WHEN 3 THEN 'ld' WHEN 4 THEN 'plain' ELSE 'deep' END || mark
        || '@firm.ru' AS email FROM ({views.FX_PROTECTED}) p WHERE custkey % 6 <> 2""",
    "scan_phase": SCAN_PHASE,
    "scan_totals": f"""WITH added AS ({SCAN_PHASE})
        SELECT (SELECT count(*) FROM pages) AS scanned, (SELECT count(*) FROM ({views.FX_SCANNED}) c WHERE NOT EXISTS (SELECT 1 FROM ({views.FX_FETCHED_PAGES}) f
            WHERE content_type = 'text/html' AND f.url IN ('https://' || c.website, 'http://' || c.website))) AS failed,
        (SELECT count(*) FROM added WHERE contact_type = 'email') AS emails_found, (SELECT count(*) FROM added WHERE contact_type = 'phone') AS phones_found""",
    "card_fields": f"""SELECT url AS source_url, page_id AS ingest_seq,
        CASE WHEN page_id % 2 = 0 THEN regexp_replace(h, '(?s):\\s+.*$', '') ELSE h END AS name,
        CAST(NULL AS VARCHAR) AS website, CAST(NULL AS VARCHAR) AS inn, '' AS phones, '' AS emails, {ACTIVE} AS status_aggregator, '2024-01-01' AS scrape_date
        FROM (SELECT url, page_id, trim(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&quot;', '"'), '&amp;', '&')) AS h FROM pages) p
        WHERE h <> ''""",
    "match_inn": f"WITH {OLD_NEW} SELECT ingest_seq, company_id FROM inc JOIN m ON m.inn = inc.inn",
    "match_website": f"WITH {OLD_NEW} SELECT ingest_seq, company_id FROM inc JOIN m ON m.website = inc.website",
    "match_source": f"WITH {OLD_NEW} SELECT old.ingest_seq, 3 AS matched_level, m.company_id FROM old JOIN m ON m.custkey = old.custkey",
    "match_name_phone": f"""WITH {OLD_NEW} SELECT ingest_seq, company_id FROM inc
        JOIN m ON m.name_norm = inc.name_norm AND m.fp = inc.fp AND (inc.inn IS NULL OR m.inn IS NULL)""",
    "match_cascade": f"""WITH {OLD_NEW} SELECT inc.ingest_seq,
        CASE WHEN a.company_id IS NOT NULL THEN 1 WHEN b.company_id IS NOT NULL THEN 2 WHEN d.company_id IS NOT NULL THEN 4 END AS matched_level,
        coalesce(a.company_id, b.company_id, d.company_id) AS company_id
        FROM inc LEFT JOIN m a ON a.inn = inc.inn LEFT JOIN m b ON b.website = inc.website
        LEFT JOIN m d ON d.name_norm = inc.name_norm AND d.fp = inc.fp AND (inc.inn IS NULL OR d.inn IS NULL)""",
    "assigned_companies": f"WITH {OLD_NEW} SELECT inc.ingest_seq, ids.company_id FROM inc JOIN ids ON ids.custkey = inc.custkey",
    "upsert_companies": f"""WITH {OLD_NEW},
        settled AS ({fold(f"(SELECT ids.company_id, {RECORD} FROM old JOIN ids ON ids.custkey = old.custkey)")}),
        both_rows AS (SELECT company_id, -1 AS seq, inn, name, website, address, status_aggregator, first_seen_at, last_seen_at, scrape_date FROM settled
          UNION ALL SELECT ids.company_id, {RECORD} FROM inc JOIN ids ON ids.custkey = inc.custkey)
        {fold('both_rows')}""",
    "upsert_sources": f"""WITH {OLD_NEW} SELECT ids.company_id, source_url, site_key, scrape_date AS first_seen_at, scrape_date AS last_seen_at
        FROM n JOIN ids ON ids.custkey = n.custkey""",
    "upsert_contacts": f"WITH {OLD_NEW}, b AS {BY_BATCH} {contacts_of('b')}",
    "upsert_kpp": f"WITH {OLD_NEW}, b AS {BY_BATCH} {kpp_of('b')}",
    "survivorship": SURVIVORS,
    "child_contacts": contacts_of(BY_SEQ),
    "child_sources": f"SELECT company_id, source_url, site_key, scrape_date AS first_seen_at, scrape_date AS last_seen_at FROM {FOUNDED} f",
    "child_kpp": kpp_of(BY_SEQ),
    "website_contact_counts": f"""WITH f AS (SELECT DISTINCT company_id, 'phone' AS t, regexp_replace(phone, '[^0-9]', '', 'g') AS k FROM {FOUNDED} f
          UNION SELECT DISTINCT company_id, 'email', email FROM {FOUNDED} f WHERE email IS NOT NULL),
        k AS (SELECT company_id, contact_type AS t, CASE WHEN contact_type = 'phone' THEN regexp_replace(value, '[^0-9]', '', 'g') ELSE value END AS k FROM {CONTACTS} c),
        x AS (SELECT * FROM f EXCEPT SELECT * FROM k)
        SELECT company_id, count(*) FILTER (t = 'email') AS new_emails, count(*) FILTER (t = 'phone') AS new_phones FROM x GROUP BY company_id""",
    "dedup_website": f"""WITH {DEDUP} SELECT company_id AS loser_id, root1 AS winner_id, 'website' AS reason, website AS key
        FROM s1 WHERE company_id <> root1""",
    "name_phone_edges": f"""SELECT a, company_id AS b, name_norm FROM (SELECT ingest_seq AS company_id, name_norm,
        min(ingest_seq) OVER (PARTITION BY name_norm, fp) AS a FROM {N} x) q WHERE a <> company_id""",
    "dedup_components": f"""SELECT company_id AS loser_id, w AS winner_id, 'name_phone' AS reason, name_norm AS key
        FROM (SELECT *, first_value(company_id) OVER (PARTITION BY name_norm, fp ORDER BY {RANK}) AS w
                FROM (SELECT ingest_seq AS company_id, inn, name_norm, fp FROM {N} x) r) q WHERE w <> company_id""",
    "dedup_companies": f"WITH {DEDUP} SELECT * EXCLUDE (custkey) FROM ({merged('s2', 'root2')}) f",
    "dedup_contacts": f"""WITH {DEDUP},
        e1 AS (SELECT root1, email, arg_min(scrape_date, {RANK}) AS seen FROM s1 WHERE email IS NOT NULL GROUP BY 1, 2)
        SELECT s2.root2 AS company_id, 'phone' AS contact_type, raw.phone AS value, raw.scrape_date AS first_seen_at, raw.scrape_date AS last_seen_at
          FROM s2 JOIN raw ON raw.company_id = s2.root2 WHERE s2.company_id = s2.root2
        UNION ALL
        SELECT s2.root2, 'email', e1.email, arg_min(e1.seen, {RANK}), arg_min(e1.seen, {RANK})
          FROM s2 JOIN e1 ON e1.root1 = s2.company_id GROUP BY s2.root2, e1.email""",
    "dedup_sources": f"""WITH {DEDUP} SELECT s2.root2 AS company_id, s1.source_url, s1.site_key, s1.scrape_date AS first_seen_at, s1.scrape_date AS last_seen_at
        FROM s1 JOIN s2 ON s2.company_id = s1.root1""",
    "merge_log": f"WITH {DEDUP} {MERGE_LOG}",
    "dedup_totals": f"WITH {DEDUP} SELECT reason, count(*) AS merges FROM ({MERGE_LOG}) l GROUP BY reason",
    "registry_report": report(),
    "report_filtered": report(suffix=f"""WHERE c.inn IS NOT NULL AND c.address ILIKE '%nation^_1%' ESCAPE '^'
        AND c.company_id IN (SELECT company_id FROM {SOURCES} s WHERE site_key = 'site1')
        AND c.company_id IN (SELECT company_id FROM {CONTACTS} s WHERE contact_type = 'phone')"""),
    "report_status_filter": report(suffix="WHERE c.status_official = 'BANKRUPT'"),
    "report_topk": report(companies=f"""(SELECT x.* FROM {COMPANIES} x JOIN (SELECT company_id, count(*) AS n FROM {SOURCES} s GROUP BY 1) q
        ON q.company_id = x.company_id ORDER BY q.n DESC, x.company_id LIMIT 100)"""),
    "report_parts": f"SELECT company_id, part, name, phones, emails, kpp, sources FROM ({report(child_cells=cells(cell_values=2))}) r",
    "report_typed": f"""SELECT company_id, coalesce(inn, '') AS inn, coalesce(ogrn, '') AS ogrn, coalesce(kpp, '') AS kpp, registration_date,
        split_part(registry_status, '|', 1) AS status_code, {label('registry_status')} AS status_label,
        {parsed('registration_date')} AS registration_date_parsed, {parsed('official_verified_at')} AS official_verified_at_parsed,
        {parsed('scrape_date')} AS scrape_date_parsed FROM ({report()}) r""",
    "companies_with_contacts": f"""SELECT c.company_id, coalesce(k.part, 0) AS part, name, status_aggregator, status_official, address, phones, emails, director,
        inn, ogrn, kpp AS kpp_list, legal_name, legal_name_official, inn_verified, registration_date, website, official_verified_at,
        scrape_date, first_seen_at, last_seen_at, sources
        FROM {COMPANIES} c LEFT JOIN {cells(kpp_separator="', '")} k ON k.company_id = c.company_id""",
    "source_counts": f"""SELECT c.company_id, count(s.source_url) AS source_count FROM {COMPANIES} c
        LEFT JOIN {SOURCES} s ON s.company_id = c.company_id GROUP BY c.company_id""",
    "payload_results": RESULTS,
    "provider_chain": CHAIN,
    "fresh_responses": f"""SELECT provider, inn, {seconds('moment')} AS fetched_at, payload
        FROM (SELECT *, fetched_at - CAST(CAST(substr(inn, 4, 7) AS INTEGER) % 48 AS INTEGER) * INTERVAL 1 HOUR AS moment FROM {RESPONSES} r) q
        WHERE moment >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY""",
    "enrich_candidates": f"SELECT company_id, inn FROM {COMPANIES} c WHERE {DUE}",
    "enrich_batch": f"""SELECT company_id, inn FROM {COMPANIES} c WHERE {DUE} AND address ILIKE '%NATION^_2%' ESCAPE '^'
        AND company_id IN (SELECT company_id FROM {SOURCES} s WHERE site_key = 'site2') ORDER BY {PRIORITY} LIMIT 50""",
    "quota_assignment": f"""SELECT inn, day, CASE WHEN rn <= 40 THEN 'A' WHEN rn <= 100 THEN 'B' END AS provider
        FROM (SELECT inn, substr(scrape_date, 1, 4) AS day, row_number() OVER (PARTITION BY substr(scrape_date, 1, 4) ORDER BY {PRIORITY}) AS rn
                FROM {COMPANIES} c WHERE inn IS NOT NULL) q""",
    "official_update": updated(["company_id", "inn", *OFFICIAL], COMPANIES, DUE.replace("inn IS", "c.inn IS").replace("official_verified_at", "c.official_verified_at")),
    "official_newest": updated(
        ["company_id", "inn", "status_official", "official_verified_at", "provider_name", "director_official"], COMPANIES,
        DUE.replace("inn IS", "c.inn IS").replace("official_verified_at", "c.official_verified_at"),
        chain=CHAIN.replace(RESPONSES, NEWEST_RESPONSES)),
    "enrichment_totals": f"""WITH w AS (SELECT inn FROM {COMPANIES} c WHERE {DUE}),
        j AS (SELECT w.inn, r.verified_at, epoch(TIMESTAMP '2024-06-01 12:01:10' - CAST(r.verified_at AS TIMESTAMP)) > 60 AS stale
                FROM w LEFT JOIN ({CHAIN}) r ON r.inn = w.inn)
        SELECT count(*) AS requested, count(verified_at) AS answered, count(*) FILTER (stale) AS cached,
               count(*) FILTER (verified_at IS NOT NULL AND NOT stale) AS fresh FROM j""",
    "scan_candidates": f"""SELECT company_id, website FROM {COMPANIES} c WHERE website IS NOT NULL AND website <> ''
        AND company_id NOT IN (SELECT company_id FROM {CONTACTS} k WHERE contact_type = 'email')""",
    "frontier_state": folded(),
    "frontier_advance": f"SELECT * EXCLUDE (site_key) FROM ({folded()}) f",
    "frontier_insert": NEW_LINKS,
    "frontier_added": f"SELECT site_key, count(*) AS added FROM ({NEW_LINKS}) l GROUP BY site_key",
    "pending_batch": f"""SELECT url, site_key, attempts, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY site_key ORDER BY url) AS INTEGER) AS rank
        FROM ({folded()}) f WHERE status = 'pending') q WHERE rank <= 10""",
    "pending_counts": f"SELECT site_key, status, count(*) AS urls FROM ({folded()}) f GROUP BY site_key, status",
    "crawl_stats": f"""WITH t AS (SELECT site_key, count(DISTINCT url) AS q, count(*) FILTER (outcome = 'completed') AS s, count(*) FILTER (outcome = 'failed') AS f,
          avg(response_sec) FILTER (outcome IN ('completed', 'failed')) AS mean_response,
          (epoch_us(max(ts) FILTER (outcome <> 'discovered')) - epoch_us(min(ts) FILTER (outcome <> 'discovered'))) / 1000000.0 AS elapsed
          FROM {OUTCOMES} o GROUP BY site_key)
        SELECT site_key, q AS queue_total, s + f AS processed_total, s AS success_count, f AS failed_count,
          round(coalesce(s * 100.0 / nullif(s + f, 0), 0.0), 1) AS success_rate_percent,
          round(coalesce((s + f) * 60.0 / nullif(elapsed, 0), 0.0), 1) AS cards_per_minute,
          round(coalesce(mean_response, 0.0), 3) AS avg_response_time_sec, round(coalesce(elapsed, 0.0), 1) AS elapsed_time_sec FROM t""",
    "page_store": """SELECT page_id, url, concat('site', CAST(page_id % 4 AS VARCHAR)) AS site_key, 'card' AS kind,
        CAST(page_id % 7 AS INTEGER) AS page_no, md5(html) AS html_md5 FROM pages""",
    "response_store": f"""SELECT provider, inn, {seconds('fetched_at')} AS fetched_at, payload FROM {RESPONSES} r
        WHERE CAST(inn AS BIGINT) % 7 <> 0 AND payload IS NOT NULL""",
    "report_file": f"SELECT company_id, part, name, address, nullif(phones, '') AS phones, nullif(sources, '') AS sources FROM ({report()}) r",
    "value_lists": """SELECT c_custkey AS custkey, CASE WHEN c_custkey % 4 > 1 THEN c_mktsegment ELSE '' END AS one,
        concat_ws('|', CASE WHEN c_custkey % 4 > 1 THEN c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN c_name || '|' || c_mktsegment END) AS both FROM customer""",
    "usable_pages": f"""SELECT page_id, final_url, content_type FROM ({views.FX_REDIRECTS}) r
        WHERE page_id % 5 IN (0, 1, 3) AND page_id % 4 IN (0, 2)""",
    "outgoing_links": f"""SELECT custkey,
          CASE custkey % 5 WHEN 0 THEN 'http://' || label || '/' WHEN 1 THEN href WHEN 3 THEN label END AS unwrapped,
          CASE custkey % 5 WHEN 0 THEN label WHEN 1 THEN 'https://' || label || '/' WHEN 3 THEN label END AS without_query
        FROM ({views.FX_OUTGOING}) o""",
    "latest_snapshot": f"""SELECT url, page_id, {seconds('fetched_at')} AS fetched_at, md5(html) AS html_md5
        FROM (SELECT * FROM {SNAPSHOTS} s QUALIFY row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC, page_id DESC) = 1) q
        WHERE fetched_at >= TIMESTAMP '2024-03-15 00:00:00' - INTERVAL 14 DAY""",
    "snapshot_history": f"""SELECT url, sha256(url) || '_' || strftime(fetched_at, '%Y-%m-%d') AS snapshot_name, {seconds('fetched_at')} AS fetched_at, page_id
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC, page_id DESC) AS rn FROM {SNAPSHOTS} s) q WHERE rn > 1
        QUALIFY row_number() OVER (PARTITION BY url, strftime(fetched_at, '%Y-%m-%d') ORDER BY fetched_at DESC, page_id DESC) = 1""",
    "unknown_sites": f"SELECT site_key, count(*) AS skipped FROM {OUTCOMES} o WHERE site_key NOT IN ('site0', 'site1') GROUP BY site_key",
    "stream_frontier": folded(),
    "repeated_arrivals": f"""WITH n AS (SELECT source_url, custkey, ingest_seq % 50 AS num, scrape_date < '{SPLIT_DATE}' AS early FROM {N} x),
        f1 AS ({founders("early")}), i1 AS ({ids_of("f1", "SELECT 0 AS company_id WHERE false")}),
        f2 AS ({founders("NOT early AND custkey NOT IN (SELECT custkey FROM f1)")}), i2 AS ({ids_of("f2", "SELECT company_id FROM i1")})
        SELECT n.source_url, i.company_id FROM n JOIN (SELECT * FROM i1 UNION ALL SELECT * FROM i2) i ON i.custkey = n.custkey""",
    "stored_deltas": fold(f"""(SELECT arg_min(ingest_seq, arrival) OVER (PARTITION BY custkey) AS company_id, arrival AS seq, inn, name, website, address,
        status_aggregator, scrape_date AS first_seen_at, scrape_date AS last_seen_at, scrape_date
        FROM (SELECT *, ingest_seq % 3 * 1000000000000 + ingest_seq AS arrival FROM {N} x) a)"""),
    "stream_upsert": f"""WITH {OLD_NEW} SELECT ids.company_id, max(inn) AS inn, max(website) AS website,
        arg_min(scrape_date, CASE WHEN scrape_date < '{SPLIT_DATE}' THEN 0 ELSE 1000000000000 END + ingest_seq) AS first_seen_at
        FROM n JOIN ids ON ids.custkey = n.custkey GROUP BY ids.company_id""",
    "quality_uniqueness": f"SELECT 'companies inn' AS check, inn AS key, count(*) AS rows FROM {N} x WHERE inn IS NOT NULL GROUP BY inn HAVING count(*) > 1",
    "quality_domain": f"SELECT 'status_official' AS check, CAST(company_id AS VARCHAR) AS key FROM {COMPANIES} c WHERE company_id % 50 = 0",
    "quality_referential": " UNION ALL ".join(
        f"""SELECT '{name}' AS check, t.company_id, count(*) AS rows FROM {table} t JOIN {COMPANIES} c ON c.company_id = t.company_id
        WHERE c.status_official IS NOT NULL GROUP BY t.company_id"""
        for name, table in [("sources", SOURCES), ("contacts", CONTACTS), ("kpp", KPP)]
    ),
    "settled_registry": f"""WITH sv AS (SELECT *, CAST(NULL AS VARCHAR) AS ogrn, CAST(NULL AS VARCHAR) AS legal_name, CAST(NULL AS VARCHAR) AS director,
          CAST(NULL AS VARCHAR) AS registration_date FROM ({SURVIVORS}) s),
        up AS ({updated(["company_id", "inn", "ogrn", "name", "legal_name", "director", "address", "website", "registration_date", "scrape_date", *OFFICIAL], "sv", "c.inn IS NOT NULL", has_official=False)}),
        kc AS ({contacts_of(BY_SEQ)}), kk AS ({kpp_of(BY_SEQ)}),
        ks AS (SELECT company_id, source_url, scrape_date AS first_seen_at FROM {FOUNDED} f)
        {report('up', cells('kc', 'kk', 'ks'))}""",
}
ORACLE["stats_file"] = ORACLE["crawl_stats"]
ORACLE["stream_discovery"] = ORACLE["discovered_frontier"]
