"""Flat HTML patterns on the JVM: text, links, attributes, protected and structured e-mails.

Rules that need the element tree live in ``operators.cards``; everything here is
one regular-expression pass inside the scan stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.contacts import decode_protected_email, format_phone
from firmament.functions.normalize import col, let, strip

# One tag; attribute values may hold ">" inside quotes.  The plain second form
# takes over where quotes do not balance.
_TAG = (
    r"""(?:</?[a-zA-Z][^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
    r"""|</?[a-zA-Z][^>]*>|<[!?][^>]*>)"""
)
_COMMENT = r"<!--(?s:.*?)(?:-->|\z)"
_HIDDEN = r"(?is)" + _COMMENT + r"|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
_ANCHOR = r"(?is)<a\s.*?(?=</a\s*>|<a\s|\z)"
_ANCHOR_TAG = r"""(?is)<a\s[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>|<a\s[^>]*>"""
_JSON_LD = (
    r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
)


def _codepoint(reference: Column) -> Column:
    """Character of one numeric reference such as ``&#64;`` or ``&#x40;``."""
    hexa = F.regexp_extract(reference, r"(?i)^&#x([0-9a-f]{1,6});$", 1)
    deci = F.regexp_extract(reference, r"^&#([0-9]{1,7});$", 1)
    point = F.when(hexa != "", F.conv(hexa, 16, 10)).otherwise(deci).cast("bigint")
    legal = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    return F.when(legal, char).otherwise(reference)


def unescape(c: Column | str) -> Column:
    """Replace character references; ``&amp;`` goes last so nothing is decoded twice."""
    c = col(c)
    numeric = F.aggregate(
        F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?i)&#(?:[0-9]{1,7}|x[0-9a-f]{1,6});"), F.lit(0))),
        c,
        lambda text, ref: F.replace(text, ref, _codepoint(ref)),
    )
    named = reduce(
        lambda text, kv: F.replace(text, F.lit(f"&{kv[0]};"), F.lit(kv[1])),
        fv.NAMED_ENTITIES.items(),
        numeric,
    )
    return F.when(c.contains("&"), named).otherwise(c)


def _unescaped_once(c: Column) -> Column:
    """``unescape`` of a costly value, which is worked out once."""
    return let(c, unescape)


def without_hidden(html: Column | str) -> Column:
    """Page source without comments, scripts, styles and templates."""
    return F.regexp_replace(col(html), _HIDDEN, " ")


def visible_text(html: Column | str) -> Column:
    """Text nodes of a page separated by blanks."""
    return _unescaped_once(F.regexp_replace(without_hidden(html), _TAG, " "))


def _inner_text(fragment: Column) -> Column:
    """Text nodes of a fragment, each stripped, glued together."""
    return _unescaped_once(F.array_join(F.transform(F.split(fragment, _TAG), strip), ""))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one start tag in any quoting style; empty when absent."""
    other = rf"""[\s"'/]*+(?!{name}\s*=)[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++))?+"""
    value = r"""(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
    # One match of the whole text, which leaves the value, or nothing where the attribute is absent.
    pattern = rf"""(?is)\A(?:<[a-z][^\s>/]*+(?:{other})*+[\s"'/]*+{name}\s*=\s*{value}.*|.*)\z"""
    return _unescaped_once(strip(F.regexp_replace(tag, pattern, "$1$2$3")))


def links(html: Column | str, text: bool = True) -> Column:
    """``array<struct<href, class, text>>`` of the page's links in document order; on request without ``text``."""

    def entry(anchor):
        parts = [attribute(anchor, "href").alias("href"), attribute(anchor, "class").alias("class")]
        if text:
            parts.append(_inner_text(F.regexp_replace(anchor, r"(?s)^" + _TAG, "")).alias("text"))
        return F.struct(*parts)

    found = F.regexp_extract_all(without_hidden(html), F.lit(_ANCHOR), F.lit(0))
    return F.filter(F.transform(found, entry), lambda a: a["href"] != "")


def link_targets(html: Column | str) -> Column:
    """Only the ``href`` values, for jobs that do not look at class or text."""
    found = F.regexp_extract_all(without_hidden(html), F.lit(_ANCHOR_TAG), F.lit(0))
    return F.filter(F.transform(found, lambda a: attribute(a, "href")), lambda h: h != "")


def mailto_emails(hrefs: Column) -> Column:
    """Addresses of ``mailto:`` links without their parameters."""
    addresses = F.transform(
        F.filter(hrefs, lambda h: F.lower(h).startswith("mailto:")),
        lambda h: F.lower(strip(F.regexp_extract(h, r"(?s)^[^:]*:([^?]*)", 1))),
    )
    return F.filter(addresses, lambda a: a.contains("@"))


def text_emails(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(fv.EMAIL_PATTERN), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def protected_emails(html: Column | str) -> Column:
    """Addresses hidden in ``data-cfemail`` attributes."""
    codes = F.regexp_extract_all(
        without_hidden(html),
        F.lit(r"""(?i)<[a-z][^>]*\sdata-cfemail\s*=\s*["']?([0-9a-f]+)["']?"""),
        F.lit(1),
    )
    decoded = F.transform(codes, lambda c: F.lower(decode_protected_email(c)))
    return F.filter(decoded, lambda e: e.contains("@"))


def _json_unescape(value: Column) -> Column:
    """Let the JSON reader undo the escapes of one string literal."""
    return F.get_json_object(F.concat(F.lit('{"v":"'), value, F.lit('"}')), "$.v")


def structured_emails(html: Column | str) -> Column:
    """Values under an ``email`` key at any depth of valid JSON-LD blocks."""
    blocks = F.regexp_extract_all(
        F.regexp_replace(col(html), _COMMENT, " "), F.lit(_JSON_LD), F.lit(1)
    )
    valid = F.filter(blocks, lambda b: F.try_parse_json(b).isNotNull())
    values = F.flatten(
        F.transform(
            valid,
            lambda b: F.regexp_extract_all(
                b, F.lit(r'(?i)"email"\s*:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)"'), F.lit(1)
            ),
        )
    )
    emails = F.transform(values, lambda v: F.lower(strip(_json_unescape(v))))
    return F.filter(emails, lambda e: e.contains("@"))


def phone_pattern(prefixes: list[str] = fv.PHONE_PREFIXES) -> str:
    return rf"(?U)(?:{'|'.join(prefixes)}){fv.PHONE_BODY_PATTERN}"


def text_phones(text: Column, prefixes: list[str] = fv.PHONE_PREFIXES) -> Column:
    """Formatted phones found in a text, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit(phone_pattern(prefixes)), F.lit(0))
    return F.array_distinct(F.array_compact(F.transform(found, format_phone)))




__all__ = [
    "attribute",
    "link_targets",
    "links",
    "mailto_emails",
    "phone_pattern",
    "protected_emails",
    "structured_emails",
    "text_emails",
    "text_phones",
    "unescape",
    "visible_text",
    "without_hidden",
]
