"""Company cards from pages by site rule.

A rule is a function from the node array to a struct of card fields, built from
column expressions only.  ``extract_cards`` accepts further rules by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.normalize import blank_to_null, first_filled, let, strip
from firmament.functions.urls import drop_query, unwrap_website
from firmament.operators.dom import first, pick, subtree, text_after, text_of, with_nodes

CARD_FIELDS = {
    "name": "string",
    "legal_name": "string",
    "inn": "string",
    "ogrn": "string",
    "registration_date": "string",
    "director": "string",
    "address": "string",
    "website": "string",
    "phones": "array<string>",
    "emails": "array<string>",
    "kpp_list": "array<string>",
    "status_aggregator": "string",
}


def _card(**fields: Column) -> Column:
    """Struct of all card fields; what a rule does not give is null."""
    return F.struct(
        *[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in CARD_FIELDS.items()]
    )


def _text_of_first(nodes: Column, scope: Column, tag: str | None = None, cls: str | None = None) -> Column:
    return let(first(pick(scope, tag, cls)), lambda e: text_of(nodes, e))


def _texts(nodes: Column, elements: Column) -> Column:
    return F.transform(elements, lambda e: text_of(nodes, e))


def _hrefs(scope: Column, scheme: str) -> Column:
    """Targets of links of one scheme without it."""
    found = pick(scope, "a", where=lambda n: n["href"].startswith(f"{scheme}:"))
    return F.transform(found, lambda a: F.replace(a["href"], F.lit(f"{scheme}:"), F.lit("")))


def _distinct_filled(values: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(values, strip), lambda v: v != ""))


def _distinct_emails(values: Column) -> Column:
    return _distinct_filled(F.transform(values, F.lower))


def _one(value: Column) -> Column:
    return F.array_compact(F.array(value))


def _concat(*arrays: Column) -> Column:
    return F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])


def _pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _look_up(pairs: Column, key: str) -> Column:
    """Value of a label; the last one on the page wins."""
    return F.try_element_at(F.filter(pairs, lambda p: p["key"] == key), F.lit(-1))["value"]


def _strong_requisites(nodes: Column, scope: Column, bare_label: bool) -> Column:
    """Label and following text of ``span.contakt`` blocks.

    ``bare_label`` keeps a block without a label under the empty key.
    """

    def label(strong):
        return F.regexp_replace(F.lower(text_of(nodes, strong)), r":+\z", "")

    def entry(span):
        return let(
            first(pick(subtree(nodes, span), "strong")),
            lambda strong: F.when(strong.isNotNull(), _pair(label(strong), text_after(nodes, strong)))
            .otherwise(_pair(F.lit("") if bare_label else F.lit(None).cast("string"), text_of(nodes, span))),
        )

    pairs = F.transform(pick(scope, "span", "contakt"), entry)
    return F.filter(pairs, lambda p: p["key"].isNotNull() & (p["value"] != ""))


def _kpp_numbers(raw: Column) -> Column:
    return F.regexp_extract_all(raw, F.lit(r"\d{9}"), F.lit(0))


def rule_a(nodes: Column) -> Column:
    """Cards with status badges and labelled spans."""
    title = _text_of_first(nodes, nodes, "h1")
    more = F.transform(
        F.filter(_texts(nodes, pick(nodes, "p", "dop-info-p")), lambda t: t.contains("Доп. телефоны:")),
        lambda t: F.split(F.replace(t, F.lit("Доп. телефоны:"), F.lit("")), "[,;]"),
    )
    site = first(pick(nodes, "a", "sitech"))
    return let(
        _strong_requisites(nodes, nodes, bare_label=False),
        lambda req: _card(
            name=strip(F.regexp_replace(title, r"(?sU):\s+.*\z", "")),
            legal_name=_look_up(req, "юридическое название"),
            inn=_look_up(req, "инн"),
            ogrn=_look_up(req, "огрн"),
            registration_date=_look_up(req, "дата регистрации"),
            director=_look_up(req, "руководитель"),
            address=blank_to_null(_text_of_first(nodes, nodes, cls="adresch2")),
            website=let(site, lambda a: unwrap_website(a["href"], text_of(nodes, a))),
            phones=_distinct_filled(_concat(_one(_text_of_first(nodes, nodes, cls="telch")), F.flatten(more))),
            emails=_distinct_emails(
                _concat(_one(_text_of_first(nodes, nodes, cls="emailchop")), _hrefs(nodes, "mailto"))
            ),
            kpp_list=_kpp_numbers(_look_up(req, "кпп")),
            status_aggregator=F.when(F.size(pick(nodes, cls="cloze")) > 0, F.lit(fv.AGGREGATOR_CLOSED))
            .when(F.size(pick(nodes, cls="cloze-perhaps")) > 0, F.lit(fv.AGGREGATOR_MAYBE))
            .otherwise(F.lit(fv.AGGREGATOR_ACTIVE)),
        ),
    )


def rule_b(nodes: Column) -> Column:
    """Cards with an information block and unlabelled legal name."""
    block = let(
        first(pick(nodes, "div", "optionally-info")),
        lambda e: F.when(e.isNotNull(), subtree(nodes, e)).otherwise(nodes),
    )
    site = first(pick(nodes, "a", "web-site-org"))
    return let(
        let(block, lambda scope: _strong_requisites(nodes, scope, bare_label=True)),
        lambda req: _card(
            name=F.coalesce(_text_of_first(nodes, nodes, "h1", "entry-title"), _text_of_first(nodes, nodes, "h1")),
            legal_name=first_filled(_look_up(req, ""), _look_up(req, "юридическое название")),
            inn=_look_up(req, "инн"),
            ogrn=_look_up(req, "огрн"),
            director=_look_up(req, "руководитель"),
            address=blank_to_null(
                F.regexp_replace(_text_of_first(nodes, nodes, "span", "address-text"), r"\.+\z", "")
            ),
            website=let(site, lambda a: unwrap_website(a["href"], text_of(nodes, a))),
            phones=_distinct_filled(
                _concat(
                    _one(_text_of_first(nodes, nodes, "span", "phone-org")),
                    _texts(nodes, pick(nodes, "span", "dop-phone")),
                )
            ),
            emails=_distinct_emails(
                _concat(_texts(nodes, pick(nodes, "span", "company-email")), _hrefs(nodes, "mailto"))
            ),
            kpp_list=_kpp_numbers(_look_up(req, "кпп")),
            status_aggregator=F.lit(fv.AGGREGATOR_ACTIVE),
        ),
    )


def text_requisites(text: Column) -> Column:
    """Identifiers and legal name found in running text."""

    def found(pattern, group=1):
        return blank_to_null(F.regexp_extract(text, "(?iuU)" + pattern, group))

    return F.struct(
        found(fv.TEXT_INN_PATTERN).alias("inn"),
        found(fv.TEXT_OGRN_PATTERN).alias("ogrn"),
        F.array_distinct(
            F.array_compact(F.array(found(fv.TEXT_KPP_PATTERN), found(fv.TEXT_INN_KPP_PATTERN)))
        ).alias("kpp_list"),
        blank_to_null(strip(found(fv.TEXT_LEGAL_NAME_PATTERN, 0))).alias("legal_name"),
    )


def _labelled_line(nodes: Column, scope: Column, label: str) -> Column:
    """Text of the line whose bold label matches, without the label."""
    bold = first(
        pick(
            scope, "b",
            where=lambda n: let(
                F.filter(subtree(nodes, n), lambda t: t["tag"] == ""),
                lambda ts: (F.size(ts) == 1) & first(ts)["text"].rlike(f"(?iu){label}"),
            ),
        )
    )
    return let(
        bold,
        lambda b: strip(F.regexp_replace(text_of(nodes, F.get(nodes, b["parent"])), rf"(?iuU)^{label}\s*:\s*", "")),
    )


def rule_c(nodes: Column) -> Column:
    """Cards with bold labels, labelled parameters and requisites in the text."""

    def parameter(p):
        def inner(scope):
            return let(
                first(pick(scope, cls="company__value")),
                lambda v: F.struct(
                    F.lower(_text_of_first(nodes, scope, cls="company__label")).alias("label"),
                    text_of(nodes, v).alias("text"),
                    _texts(nodes, pick(subtree(nodes, v), "div")).alias("lines"),
                    F.transform(
                        pick(subtree(nodes, v), "a",
                             where=lambda a: a["href"].isNotNull() & ~a["href"].startswith("javascript")),
                        lambda a: strip(a["href"]),
                    ).alias("hrefs"),
                ),
            )

        return let(subtree(nodes, p), inner)

    def gather(parameters, wanted, field):
        """Lines of the matching parameters; the whole text only while nothing was found."""
        return F.aggregate(
            F.filter(parameters, wanted),
            F.array().cast("array<string>"),
            lambda acc, p: let(
                F.concat(acc, p[field]),
                lambda grown: F.when(F.size(grown) > 0, grown)
                .when(F.size(p["lines"]) > 0, p["lines"])
                .otherwise(F.array(p["text"])),
            ),
        )

    def is_phone(p):
        return p["label"].contains("телефон")

    def is_email(p):
        return ~is_phone(p) & (p["label"].contains("email") | p["label"].contains("почта"))

    def is_site(p):
        return ~is_phone(p) & ~is_email(p) & p["label"].contains("сайт")

    parameters = F.filter(
        F.transform(pick(nodes, cls="company__param"), parameter),
        lambda p: p["label"].isNotNull() & p["text"].isNotNull(),
    )
    fields = let(first(pick(nodes, cls="fields")), lambda e: subtree(nodes, e))
    prose = F.concat_ws(
        " ",
        let(first(pick(nodes, cls="text")), lambda e: text_of(nodes, e, " ")),
        let(first(pick(nodes, cls="entity-tabs")), lambda e: text_of(nodes, e, " ")),
    )
    return let(
        F.struct(
            parameters.alias("params"),
            let(prose, text_requisites).alias("req"),
            let(
                fields,
                lambda scope: F.struct(
                    _labelled_line(nodes, scope, "адрес").alias("address"),
                    F.coalesce(
                        _labelled_line(nodes, scope, "руководитель"), _labelled_line(nodes, scope, "владелец")
                    ).alias("director"),
                ),
            ).alias("lines"),
        ),
        lambda x: _card(
            name=_text_of_first(nodes, nodes, "h1"),
            legal_name=x["req"]["legal_name"],
            inn=x["req"]["inn"],
            ogrn=x["req"]["ogrn"],
            director=x["lines"]["director"],
            address=x["lines"]["address"],
            website=F.get(gather(x["params"], is_site, "hrefs"), F.lit(0)),
            phones=gather(x["params"], is_phone, "lines"),
            emails=gather(x["params"], is_email, "lines"),
            kpp_list=x["req"]["kpp_list"],
            status_aggregator=F.lit(fv.AGGREGATOR_ACTIVE),
        ),
    )


def rule_d(nodes: Column) -> Column:
    """Cards scoped to a contacts block, with a requisites block of ``label: value`` lines."""
    contacts = let(
        first(pick(nodes, cls="about__contacts")),
        lambda e: F.when(e.isNotNull(), subtree(nodes, e)).otherwise(nodes),
    )

    def link_values(scope, scheme):
        """Link text, or the target where the link has none."""
        found = pick(scope, "a", where=lambda n: n["href"].startswith(f"{scheme}:"))
        return F.transform(
            found,
            lambda a: first_filled(text_of(nodes, a), F.replace(a["href"], F.lit(f"{scheme}:"), F.lit(""))),
        )

    def site_link(scope):
        globe = first(
            pick(scope, "li", where=lambda li: F.size(pick(subtree(nodes, li), "i", "fa-globe")) > 0)
        )
        tagged = first(pick(scope, "a", where=lambda a: a["href"].contains("utm_source=")))
        return F.coalesce(let(globe, lambda li: first(pick(subtree(nodes, li), "a"))), tagged)

    def is_requisites(block):
        heading = _text_of_first(nodes, subtree(nodes, block), "span", "about__small")
        return F.coalesce(F.lower(heading).contains("реквизиты"), F.lit(False))

    lines = F.flatten(
        F.transform(
            pick(nodes, cls="about__block", where=is_requisites),
            lambda b: _texts(nodes, pick(subtree(nodes, b), "div")),
        )
    )
    pairs = F.transform(
        F.filter(lines, lambda t: t.contains(":")),
        lambda t: _pair(
            F.lower(strip(F.substring_index(t, ":", 1))), strip(F.regexp_replace(t, r"(?s)^[^:]*:", ""))
        ),
    )
    return let(
        F.struct(pairs.alias("req"), contacts.alias("scope")),
        lambda x: _card(
            name=F.coalesce(_text_of_first(nodes, nodes, "h1", "about__title"), _text_of_first(nodes, nodes, "h1")),
            legal_name=first_filled(_look_up(x["req"], "полное название"), _look_up(x["req"], "полное наименование")),
            inn=_look_up(x["req"], "инн"),
            ogrn=_look_up(x["req"], "огрн"),
            director=_look_up(x["req"], "руководитель"),
            address=blank_to_null(_text_of_first(nodes, nodes, "span", "about__address")),
            website=let(site_link(x["scope"]), lambda a: drop_query(a["href"], text_of(nodes, a))),
            phones=_distinct_filled(
                _concat(_texts(nodes, pick(x["scope"], "a", "about__phone")), link_values(x["scope"], "tel"))
            ),
            emails=_distinct_emails(
                _concat(_texts(nodes, pick(x["scope"], "a", "about__email")), link_values(x["scope"], "mailto"))
            ),
            kpp_list=_kpp_numbers(_look_up(x["req"], "кпп")),
            status_aggregator=F.lit(fv.AGGREGATOR_ACTIVE),
        ),
    )


CARD_RULES = {"site_a": rule_a, "site_b": rule_b, "site_c": rule_c, "site_d": rule_d}

# A page of this rule counts as a card as soon as it has a heading, even an empty one.
_EMPTY_NAME_ALLOWED = ["site_c"]


def extract_cards(pages: DataFrame, rules: dict = CARD_RULES) -> DataFrame:
    """Company records of card pages.

    ``pages(url, site_key, rule_key, scrape_date, ingest_seq, html)``.  Pages without a
    name give no row.
    """
    nodes = F.col("nodes")
    card = F.lit(None)
    for key, rule in rules.items():
        card = F.when(F.col("rule_key") == key, rule(nodes)).otherwise(card)
    wanted = pages.select("url", "site_key", "rule_key", "scrape_date", "ingest_seq", "html").filter(
        F.col("rule_key").isin(list(rules))
    )
    # The generator evaluates each card once, whatever is selected or filtered above it.
    cards = with_nodes(wanted).select(
        F.col("url").alias("source_url"), "site_key", "rule_key", "scrape_date", "ingest_seq",
        F.inline(F.array(card)),
    )
    named = (F.col("name") != "") | (F.col("name").isNotNull() & F.col("rule_key").isin(_EMPTY_NAME_ALLOWED))
    return cards.filter(named).drop("rule_key").withColumn("last_seen_at", F.lit(None).cast("string"))
