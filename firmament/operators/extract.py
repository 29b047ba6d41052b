"""Link and contact extraction from page tables, and the company-site scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions import html as H
from firmament.functions import urls as U
from firmament.functions.contacts import is_valid_email
from firmament.functions.normalize import let
from firmament.operators.skew import dealt, top_k_per_group
from firmament.session import stored

# Pages that one task of a site scan parses.
PAGES_PER_TASK = 1000


def page_card_links(pages: DataFrame, rules: DataFrame, *also: str) -> DataFrame:
    """Listing pages with the array of card URLs their site's rule accepts.

    ``pages(site_key, page_no, html, ...)``; ``rules`` is the bounded rule table; columns
    named in ``also`` are kept.
    """

    # Rules without a prefix keep the path as it is; their pattern has no slug group.
    prefixed = F.col("card_prefix").isNotNull()

    def entry(a):
        return let(
            U.path(a["href"]),
            lambda path: F.struct(
                a["class"].alias("class"), path.alias("path"),
                F.when(prefixed, F.call_function("regexp_extract", path, F.col("path_pattern"), F.lit(1))).alias("slug"),
            ),
        )

    def accept(a):
        by_class = F.col("link_class").isNull() | F.array_contains(
            F.split(a["class"], r"\s+"), F.col("link_class")
        )
        by_slug = ~prefixed | ((a["slug"] != "") & ~F.array_contains(F.col("skip_slugs"), a["slug"]))
        return by_class & F.regexp_like(a["path"], F.col("path_pattern")) & by_slug

    def card_url(a):
        return F.when(
            prefixed,
            F.concat("origin", "card_prefix", a["slug"], F.lit("/")),
        ).otherwise(U.resolve(F.concat("origin", F.lit("/")), a["path"]))

    urls = F.array_distinct(F.transform(F.filter(F.transform(H.links("html", text=False), entry), accept), card_url))
    return pages.join(F.broadcast(rules), "site_key").select("site_key", "page_no", *also, urls.alias("links"))


def extract_links(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Card links as rows ``(site_key, page_no, url)``, distinct per page."""
    return link_rows(page_card_links(pages, rules))


def link_rows(page_links: DataFrame) -> DataFrame:
    return page_links.select("site_key", "page_no", F.explode("links").alias("url"))


def page_emails(html: Column | str) -> Column:
    """E-mail candidates of a page from links, text, protected attributes and JSON-LD."""
    return F.array_union(
        F.array_union(H.mailto_emails(H.link_targets(html)), H.text_emails(H.visible_text(html))),
        F.array_union(H.protected_emails(html), H.structured_emails(html)),
    )


def page_contacts(
    pages: DataFrame,
    junk_local_parts: list[str] = fv.JUNK_LOCAL_PARTS,
    junk_domains: list[str] = fv.JUNK_DOMAINS,
    phone_prefixes: list[str] = fv.PHONE_PREFIXES,
) -> DataFrame:
    """Adds ``emails`` and ``phones`` to a page table and drops the HTML."""
    valid = F.filter(
        page_emails("html"), lambda e: is_valid_email(e, junk_local_parts, junk_domains)
    )
    return pages.withColumns(
        {"emails": valid, "phones": H.text_phones(H.visible_text("html"), phone_prefixes)}
    ).drop("html")


def text_contacts(texts: DataFrame, text: str, **lists) -> DataFrame:
    """Valid e-mails and phones of plain texts.

    The generated row keeps later filters above it, so that each text is read once.
    """
    prefixes = lists.pop("phone_prefixes", fv.PHONE_PREFIXES)
    found = F.struct(
        F.filter(H.text_emails(F.col(text)), lambda e: is_valid_email(e, **lists)).alias("emails"),
        H.text_phones(F.col(text), prefixes).alias("phones"),
    )
    return texts.select(*[c for c in texts.columns if c != text], F.inline(F.array(found)))


def contact_links(base_url: Column, html: Column | str, limit: int = 0) -> Column:
    """Same-host links that look like contact pages, else the usual paths; with a limit the first ones."""
    pattern = "(?iuU)" + fv.CONTACT_LINK_PATTERN
    skipped = "^(?:" + "|".join(fv.SKIPPED_HREF_PREFIXES) + ")"

    def entry(a):
        return F.struct(
            U.resolve(base_url, a["href"]).alias("url"),
            (a["href"].rlike(pattern) | a["text"].rlike(pattern)).alias("wanted"),
        )

    def same_host(url):
        host = U.netloc(url)
        return (host == "") | (host == U.netloc(base_url))

    real = F.filter(H.links(html), lambda a: ~a["href"].rlike(skipped))
    found = F.filter(F.transform(real, entry), lambda e: e["wanted"] & same_host(e["url"]))
    usual = F.array(*[F.concat(U.origin(base_url), F.lit(p)) for p in fv.FALLBACK_PATHS])

    def chosen(urls):
        links = F.when(F.size(urls) > 0, urls).otherwise(usual)
        return F.slice(links, 1, limit) if limit > 0 else links

    return let(F.array_distinct(F.transform(found, lambda e: e["url"])), chosen)


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages that stayed on their site and hold text."""
    return pages.filter(U.same_site("url", "final_url") & U.is_text_content("content_type"))


def main_addresses(companies: DataFrame) -> DataFrame:
    """``(company_id, scheme, url)``: the addresses that a company's main page may have."""
    schemes = F.array(F.lit("https://"), F.lit("http://"))
    return companies.filter(F.col("website").isNotNull()).select(
        "company_id", F.posexplode(F.transform(schemes, lambda s: F.concat(s, F.col("website")))).alias("scheme", "url")
    )


def pages_of_hosts(pages: DataFrame, addresses: DataFrame) -> DataFrame:
    """Pages on the host of one of the addresses."""
    hosts = addresses.select(U.netloc("url").alias("_host")).distinct()
    return pages.withColumn("_host", U.netloc("url")).join(hosts, "_host", "left_semi").drop("_host")


def scan_sites(companies: DataFrame, pages: DataFrame, max_pages: int = 0, **lists) -> DataFrame:
    """Contacts from the main page and all contact pages of company sites.

    Nothing is fetched here, so every page that lies in storage counts; ``max_pages``
    keeps a company to its first ones.

    ``companies(company_id, website)``, ``pages(url, html)`` with one row per URL.
    Returns ``(company_id, contact_type, value)``.  The HTML of a page is turned into
    contacts and links once and kept; only those narrow results are shuffled.  Pages of hosts
    that no company asks for are left out before that, as main and contact pages share a host,
    and the others are dealt again, since the join leaves them in tasks sized by their bytes.
    The main page is the https one when there is one.
    """
    wanted = main_addresses(companies)
    asked = dealt(pages_of_hosts(pages, wanted).select("url", "html"), pages.count(), PAGES_PER_TASK, "url")
    digest = stored(page_contacts(asked.withColumn("links", contact_links(F.col("url"), "html")), **lists))
    main = (
        wanted.join(digest, "url")
        .groupBy("company_id")
        .agg(F.min(F.struct("scheme", "links", "emails", "phones")).alias("m"))
        .select("company_id", "m.*")
    )
    linked = (
        main.select("company_id", F.posexplode("links").alias("pos", "url"))
        .join(digest.select("url", "emails", "phones"), "url")
    )
    extra = linked
    if max_pages > 0:
        extra = top_k_per_group(linked, ["company_id"], [F.col("pos")], max_pages - 1, "url")
    per_page = main.select("company_id", "emails", "phones").unionByName(extra.select("company_id", "emails", "phones"))

    def tagged(kind, c):
        return F.transform(F.col(c), lambda v: F.struct(F.lit(kind).alias("contact_type"), v.alias("value")))

    return per_page.select(
        "company_id", F.inline(F.concat(tagged("email", "emails"), tagged("phone", "phones")))
    ).distinct()


def scan_totals(companies: DataFrame, pages: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: companies scanned, those without a landed main page, and contacts really added.

    Every company that was to be scanned is accounted for: its main page is in ``pages(url)``, or its
    scan has failed.
    """
    asked = companies.select("company_id").distinct()
    landed = main_addresses(companies).join(pages.select("url"), "url", "left_semi").select("company_id").distinct()
    outcome = asked.join(landed.withColumn("landed", F.lit(True)), "company_id", "left").select(
        F.when(F.col("landed"), "landed").otherwise("failed").alias("kind"))
    rows = outcome.unionByName(inserted.select(F.col("contact_type").alias("kind")))

    def counted(*kinds):
        return F.count_if(F.col("kind").isin(*kinds))

    return rows.agg(
        counted("landed", "failed").alias("scanned"), counted("failed").alias("failed"),
        counted("email").alias("emails_found"), counted("phone").alias("phones_found"),
    )
