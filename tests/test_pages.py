"""Hand-written pages with invented companies for every link, card and contact rule."""

from pyspark.sql import functions as F

from firmament.operators import cards, dom, extract
from firmament.operators.records import normalize_listings
from firmament.sources import sites


def test_listing_links(spark):
    pages = spark.createDataFrame([
        ("chop.moscow", 1, "<a href='/catalog/alfa/'>A</a><a href='/catalog/alfa'>A</a><a href=/catalog/page/>x</a><a href='/catalog/a/b/'>x</a><a class=k href='https://chop.moscow/catalog/beta/?x=1'>B</a>"),
        ("prochop.ru", 1, "<a class='title-arhive-chops' href='/chops/gamma/'>G</a><a href='/chops/tag/'>t</a>"),
        ("russkiisoyuz", 1, "<a class='big title' href='/msk/services/delta/?p=2'>D</a><a href='/msk/services/eps/'>no class</a><a class='title' href='/other/'>o</a>"),
        ("vsechopy-mo", 1, "<!-- <a href='/chop/zeta/'>z</a> --><a href='/chop/eta/'>E</a><a href='/chop/city/'>c</a>"),
        ("nowhere", 1, "<a href='/chop/eta/'>E</a>"),
    ], "site_key string, page_no int, html string")
    got = {(r.site_key, r.url) for r in extract.extract_links(pages, sites.link_rules(spark)).collect()}
    assert got == {
        ("chop.moscow", "https://chop.moscow/catalog/alfa/"),
        ("chop.moscow", "https://chop.moscow/catalog/beta/"),
        ("prochop.ru", "https://prochop.ru/chops/gamma/"),
        ("russkiisoyuz", "https://xn--g1abdcwihado2k.xn--p1ai/msk/services/delta/"),
        ("vsechopy-mo", "https://xn--b1ag1aeh1b4a.xn--p1ai/chop/eta/"),
    }
    assert [tuple(r) for r in sites.unknown_sites(pages, sites.site_table(spark)).collect()] == [("nowhere", 1)]


def test_catalog_page_urls(spark):
    urls = spark.range(1, 3).select(
        sites.catalog_page_url(F.lit("https://c.example/x"), F.lit(sites.QUERY_PAGE_PATTERN), F.col("id")).alias("u")
    )
    assert [r.u for r in urls.collect()] == ["https://c.example/x/", "https://c.example/x/?page=2"]


A = """<html><h1>Щит и меч:  отзывы</h1><div class="cloze-perhaps x">?</div>
<span class="contakt"><strong>ИНН:</strong> 1111111111</span>
<span class="contakt"><strong>ИНН</strong> 7700 000 001</span>
<span class="contakt"><strong>ОГРН</strong><br>1027700000001</span>
<span class="contakt"><strong>КПП</strong> 770101001, 500101002</span>
<span class="contakt"><strong>Руководитель:</strong> Петров <a href="#">Пётр</a></span>
<span class="contakt"><strong>Дата регистрации</strong> 17.06.2011</span>
<span class="contakt"><strong>Юридическое название</strong> ООО &laquo;Щит&raquo;</span>
<span class="contakt">без ключа</span>
<p class="adresch2"> г. Москва, <b>ул. Новая</b> </p><span class="telch">+7 (495) 111-22-33 (факс)</span>
<p class="dop-info-p">Доп. телефоны: 8 495 1112244; 8 495 1112255,+7 (495) 111-22-33</p><p class="dop-info-p">Прочее: 1</p>
<b class="emailchop">Info@Shield.ru</b><a href="mailto:info@shield.ru">m</a><a href="mailto:b@shield.ru?subject=x">m</a>
<a class="sitech" href="/go?url=www.shield.ru&amp;x=1">s</a></html>"""

B = """<h1>Портал</h1><h1 class="entry-title">Цербер</h1><span class="contakt"><strong>ИНН</strong> 999</span>
<div class="optionally-info"><span class="contakt"><strong></strong> ООО "Цербер"</span>
<span class="contakt"><strong>ОГРН </strong> 1032128005425</span><span class="contakt"><strong>КПП</strong>770101001</span></div>
<span class="address-text"><span itemprop="a">Чебоксары,</span> <span>ул. 1</span>.</span>
<span class="phone-org">+7 (495) 222-22-22</span><span class="dop-phone">8 (495) 333-33-33</span><span class="dop-phone"></span>
<span class="company-email">a@cerber.ru</span><span class="company-email">A@cerber.ru</span>
<a class="web-site-org" href="http://cerber.ru">x</a>"""

C = """<h1>Дозор</h1><div class="fields"><p><b>Адрес:</b> Тула, ул. 2</p><p><b>Владелец</b>: Сидоров С.</p></div>
<div class="company__param"><div class="company__label">Телефоны</div><div class="company__value"><div>8 495 4444444</div><div>8 495 5555555</div></div></div>
<div class="company__param"><div class="company__label">E-mail / почта</div><div class="company__value">d@dozor.ru</div></div>
<div class="company__param"><div class="company__label">Сайт</div><div class="company__value"><a href="javascript:void(0)">x</a><a href="https://dozor.ru/ ">d</a></div></div>
<div class="company__param"><div class="company__label">Лицензия</div></div>
<div class="text">Охрана. ИНН/КПП: 5025032116/502501001, ОГРН 1035004457034.</div><div class="entity-tabs">ЧОО «Дозор» (реклама)</div>"""

D = """<h1 class="about__title">Сокол</h1><span class="about__address">Екатеринбург</span>
<div class="about__block"><span class="about__small">Наши реквизиты</span><div>ИНН: 6600000001</div><div>КПП: 660101001</div>
<div>Полное наименование: ООО "Сокол": охрана</div><div>Руководитель: Орлов О.</div></div>
<div class="about__block"><span class="about__small">Прочее</span><div>ИНН: 1</div></div>
<ul class="about__contacts"><li><a class="about__phone" href="tel:+73431112233">+7 (343) 111-22-33</a></li><li><a href="tel:83431112244"></a></li>
<li><a href="mailto:s@sokol.ru">S@sokol.ru</a></li><li><i class="fa fa-globe"></i> <a href="http://sokol.ru/?utm_source=c">сайт</a></li></ul>
<a href="tel:000">чужой</a>"""


def card_pages(spark):
    rows = [("u_a", "site_a", A), ("u_b", "site_b", B), ("u_c", "site_c", C), ("u_d", "site_d", D),
            ("u_none", "site_a", "<p>без имени</p>"), ("u_empty", "site_d", "<h1> </h1>"), ("u_empty_c", "site_c", "<h1></h1>"),
            ("u_other", "unknown", "<h1>x</h1>"), ("u_null", "site_b", None)]
    return spark.createDataFrame(
        [(u, k, k, "2024-01-01", i, h) for i, (u, k, h) in enumerate(rows)],
        "url string, site_key string, rule_key string, scrape_date string, ingest_seq long, html string",
    )


def test_cards(spark):
    got = {r.source_url: r.asDict() for r in normalize_listings(cards.extract_cards(card_pages(spark))).collect()}
    assert set(got) == {"u_a", "u_b", "u_c", "u_d", "u_empty_c"}

    def fields(key, **expected):
        assert {k: got[key][k] for k in expected} == expected

    fields("u_a", name="Щит и меч", inn="7700000001", ogrn="1027700000001", kpp_list=["770101001", "500101002"],
           director="Петров Пётр", registration_date="17.06.2011", legal_name="ООО «Щит»", address="г. Москва,ул. Новая",
           phones=["+7 (495) 111-22-33", "8 495 1112244", "8 495 1112255"],
           emails=["info@shield.ru", "b@shield.ru?subject=x"], website="shield.ru",
           status_aggregator="Компания, возможно, не работает", last_seen_at="2024-01-01")
    fields("u_b", name="Цербер", legal_name='ООО "Цербер"', ogrn="1032128005425", inn=None, kpp_list=["770101001"],
           address="Чебоксары,ул. 1", phones=["+7 (495) 222-22-22", "8 (495) 333-33-33"], emails=["a@cerber.ru"],
           website="cerber.ru", status_aggregator="Работает", director=None)
    fields("u_c", name="Дозор", address="Тула, ул. 2", director="Сидоров С.", inn="5025032116", ogrn="1035004457034",
           kpp_list=["502501001"], phones=["8 495 4444444", "8 495 5555555"], emails=["d@dozor.ru"], website="dozor.ru",
           legal_name="ЧОО «Дозор")
    fields("u_d", name="Сокол", inn="6600000001", kpp_list=["660101001"], legal_name='ООО "Сокол": охрана',
           director="Орлов О.", address="Екатеринбург", phones=["+7 (343) 111-22-33", "83431112244"],
           emails=["s@sokol.ru"], website="sokol.ru")


def test_reference_needs_its_semicolon(spark):
    html = """<h1>a &amp;&amp; b&amp &am &notit; &copy; &#64; &amp;#65;</h1><a class="sitech" href="https://x.ru/?a=1&copy=2&amp;b">s</a>"""
    pages = spark.createDataFrame([("u", "k", "site_a", "2024-01-01", 1, html)],
                                  "url string, site_key string, rule_key string, scrape_date string, ingest_seq long, html string")
    row = cards.extract_cards(pages).first()
    assert (row.name, row.website) == ("a && b&amp &am &notit; © @ &#65;", "https://x.ru/?a=1&copy=2&b")


def test_closed_badge_wins(spark):
    page = "<h1>Имя</h1><i class='cloze-perhaps'></i><i class='cloze'></i>"
    pages = spark.createDataFrame([("u", "s", "site_a", "2024-01-01", 1, page)],
                                  "url string, site_key string, rule_key string, scrape_date string, ingest_seq long, html string")
    assert cards.extract_cards(pages).first().status_aggregator == "Компания больше не работает"


CODE = "54" + "".join(f"{ord(c) ^ 0x54:02x}" for c in "Hidden@firm.ru")

CONTACTS = f"""<html><!-- no@comment.ru --><script>var a='no@script.ru'</script><style>no@style.ru</style>
<script type="application/ld+json">{{"@type":"Org","sub":[[{{"Email":" Ld@firm.ru "}}]],"x":{{"email":"deep\\u0040firm.ru"}}}}</script>
<script type='application/ld+json'>{{bad, "email":"bad@firm.ru"}}</script>
<a href='MAILTO:Sales@firm.ru?subject=hi'>m</a><a href="mailto:nothing">n</a>
<span data-cfemail='{CODE}'>x</span> text w&#64;firm.ru, noreply@firm.ru, pic@2x.png, u@example.com
+7&nbsp;(495) 123-45-67, 8 800 <b>555</b> 35 35; 8 (495) 12</html>"""


def test_contacts(spark):
    row = extract.page_contacts(spark.createDataFrame([(1, CONTACTS)], "id int, html string")).first()
    assert sorted(row.emails) == sorted(["sales@firm.ru", "w@firm.ru", "hidden@firm.ru", "ld@firm.ru", "deep@firm.ru"])
    assert row.phones == ["+7 (495) 123-45-67", "+7 (800) 555-35-35"]


def test_whole_text_is_read(spark):
    html = "<p>" + "слово " * 200_000 + "late@firm.ru</p>"
    row = extract.page_contacts(spark.createDataFrame([(1, html)], "id int, html string")).first()
    assert row.emails == ["late@firm.ru"]


def test_contact_links(spark):
    html = """<a href='/o-nas'>О нас</a><a href='tel:1'>контакты</a><a href='https://other.ru/contact'>c</a>
    <a href='kontakty.html'>Наши <b>контакты</b></a><a href='https://firm.ru/about'>x</a><a href='/o-nas'>О компании</a>"""
    pages = spark.createDataFrame([("https://firm.ru", html), ("https://bare.ru", "<p>x</p>")], "url string, html string")
    got = {r.url: r.l for r in pages.select("url", extract.contact_links(F.col("url"), "html").alias("l")).collect()}
    assert got["https://firm.ru"] == ["https://firm.ru/o-nas", "https://firm.ru/kontakty.html", "https://firm.ru/about"]
    assert got["https://bare.ru"] == [f"https://bare.ru{p}" for p in ["/contacts", "/kontakty", "/contact", "/about", "/about-us", "/o-kompanii", "/o-nas"]]
    two = pages.select(F.size(extract.contact_links(F.col("url"), "html", 2)).alias("n"))
    assert {r.n for r in two.collect()} == {2}


def test_site_scan(spark):
    companies = spark.createDataFrame([(1, "firm.ru"), (2, "plain.ru"), (3, "gone.ru"), (4, None), (5, "firm.ru")], "company_id long, website string")
    pages = spark.createDataFrame([
        ("https://firm.ru", "main@firm.ru <a href='/contact1'>x</a><a href='/contact2'>x</a><a href='/contact3'>x</a><a href='/contact4'>x</a><a href='/contact5'>x</a>"),
        ("http://firm.ru", "http@firm.ru"),
        ("https://firm.ru/contact2", "two@firm.ru main@firm.ru"),
        ("https://firm.ru/contact3", "three@firm.ru"), ("https://firm.ru/contact4", "four@firm.ru"),
        ("https://firm.ru/contact5", "five@firm.ru"),
        ("http://plain.ru", "8 495 1234567"), ("http://plain.ru/about", "p@plain.ru"),
    ], "url string, html string")
    got = {tuple(r) for r in extract.scan_sites(companies, pages).collect()}
    firm = [("email", f"{n}@firm.ru") for n in ["main", "two", "three", "four", "five"]]
    first = {tuple(r) for r in extract.scan_sites(companies, pages, max_pages=3).collect()}
    assert {x for c, *x in ((r[0], r[2]) for r in first if r[0] == 1) for x in x} == {"main@firm.ru", "two@firm.ru", "three@firm.ru"}
    assert got == {(c, *x) for c in (1, 5) for x in firm} | {(2, "phone", "+7 (495) 123-45-67"), (2, "email", "p@plain.ru")}


def test_unusable_pages(spark):
    pages = spark.createDataFrame([
        ("https://a.ru", "https://www.a.ru/", "text/html; charset=utf-8"), ("https://b.ru", "https://parked.reg.ru/b.ru", "text/html"),
        ("https://c.ru", "https://c.ru", "application/pdf"), ("https://d.ru", "https://d.ru", "text/plain"), ("https://e.ru", "https://e.ru", None),
    ], "url string, final_url string, content_type string")
    assert sorted(r.url for r in extract.usable_pages(pages).collect()) == ["https://a.ru", "https://d.ru"]


def test_scan_accounts_for_every_company(spark):
    """Pages of other hosts are left out before parsing; a company without a landed main page has failed."""
    companies = spark.createDataFrame([(1, "firm.ru"), (2, "gone.ru"), (3, None), (4, "firm.ru")], "company_id long, website string")
    pages = spark.createDataFrame([("https://firm.ru", "a@firm.ru"), ("https://firm.ru/contacts", "b@firm.ru"), ("https://else.ru", "c@else.ru")],
                                  "url string, html string")
    kept = extract.pages_of_hosts(pages, extract.main_addresses(companies))
    assert {r.url for r in kept.collect()} == {"https://firm.ru", "https://firm.ru/contacts"}
    added = spark.createDataFrame([(1, "email"), (1, "email"), (4, "phone")], "company_id long, contact_type string")
    assert tuple(extract.scan_totals(companies, pages, added).first()) == (4, 2, 2, 1)


def test_plain_tags_give_the_nodes_of_the_parser():
    plain = ["<!doctype html><title>a &lt b &lt;</title><script>var t='</p>'; a<b</script>x<br/><p class='a  b'>y<div Href=q id>z</DIV>",
             "<ul><li>a<li>b</ul><!-- c --><td>d<template>e</template>&#64;&amp&copy;<a href=''>f</a></x>"]
    other = ["<a href=/x/y>z</a>", "<p><!doctype html>", "<!-->x-->", "a<b", "<a b = 'c'>d", "</p class='x'>", "<script><!-- </script>", "<textarea><b></textarea>"]
    for html in [*plain, *other, "", "<"]:
        parser = dom._NodeList()
        parser.feed(dom._references_only(html))
        assert dom.page_nodes(html) == parser.finish(), html
    assert all(dom._plain_nodes(html) is not None for html in plain) and not any(dom._plain_nodes(html) for html in other)


def test_site_scan_parses_pages_in_tasks_of_bounded_size(spark, monkeypatch):
    companies = spark.range(3000).select(F.col("id").alias("company_id"), F.concat(F.lit("firm"), "id", F.lit(".ru")).alias("website"))
    pages = companies.select(F.concat(F.lit("https://"), "website").alias("url"), F.concat(F.lit("<p>mail a"), "company_id", F.lit("@firm.ru</p>")).alias("html"))
    sizes, parse = [], extract.page_contacts

    def counted(df, **lists):
        sizes.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return parse(df, **lists)

    monkeypatch.setattr(extract, "page_contacts", counted)
    monkeypatch.setattr(extract, "PAGES_PER_TASK", 250, raising=False)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        found = extract.scan_sites(companies, pages)
        assert found.count() == 3000
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert sum(sizes) == 3000 and max(sizes) < 400
