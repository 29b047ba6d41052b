"""URL parts, reference resolution and the link tests built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.normalize import blank_to_null, col, let

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"


def url_key(c: Column | str) -> Column:
    """Cache key of a page: SHA-256 of its address."""
    return F.sha2(col(c), 256)


def netloc(c: Column | str) -> Column:
    """Host and port in lower case; empty when the reference has none."""
    return F.lower(F.regexp_extract(col(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1))


def origin(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)


def path(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def remove_dot_segments(p: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path."""
    tail = F.when(p.rlike(r"/\.{1,2}\z"), F.lit("/")).otherwise(F.lit(""))
    folded = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(
            s == "..",
            F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc),
        )
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.when(p.rlike(r"(^|/)\.{1,2}(/|\z)"), F.concat(F.array_join(folded, "/"), tail)).otherwise(p)


def resolve(base: Column | str, href: Column | str) -> Column:
    """Absolute form of a link found on the page at ``base``."""
    base, href = col(base), col(href)
    root = origin(base)
    base_path = path(base)
    directory = F.when(base_path == "", F.lit("/")).otherwise(
        F.regexp_replace(base_path, r"[^/]*\z", "")
    )
    suffix = F.regexp_extract(href, r"([?#].*)\z", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), href))
        .when(href.startswith("/"), F.concat(root, remove_dot_segments(path(href)), suffix))
        .when(href.startswith("?"), F.concat(root, base_path, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*\z", ""), href))
        .otherwise(F.concat(root, remove_dot_segments(F.concat(directory, path(href))), suffix))
    )


def same_site(requested: Column | str, final: Column | str,
              parking: list[str] = fv.PARKING_DOMAINS) -> Column:
    """True when a redirect stayed on the requested site and off parking hosts."""

    def judge(hosts):
        asked, got = hosts["asked"], hosts["got"]
        bare = F.regexp_replace(asked, r"^www\.", "")
        parked = F.exists(F.array(*[F.lit(d) for d in parking]), lambda d: F.contains(got, d))
        stayed = (F.regexp_replace(got, r"^www\.", "") == bare) | F.endswith(
            got, F.concat(F.lit("."), bare)
        )
        return (asked == got) | (~parked & stayed)

    return let(F.struct(netloc(requested).alias("asked"), netloc(final).alias("got")), judge)


def is_text_content(content_type: Column | str) -> Column:
    c = F.coalesce(col(content_type), F.lit(""))
    test = F.lit(False)
    for kind in fv.TEXT_CONTENT_TYPES:
        test = test | c.contains(kind)
    return test


def unwrap_website(href: Column | str, text: Column | str) -> Column:
    """Target of an outgoing link: its ``url=`` parameter, itself, or its text."""
    href, text = col(href), col(text)
    inside = F.regexp_extract(href, "url=([^&]+)", 1)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", F.lit(None))
        .when(href.contains("url="), F.coalesce(blank_to_null(inside), blank_to_null(text)))
        .when(href.startswith("http"), href)
        .otherwise(blank_to_null(text))
    )


def drop_query(href: Column | str, text: Column | str) -> Column:
    """Outgoing link without its query string, or the link text."""
    href, text = col(href), col(text)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", F.lit(None))
        .when(href.startswith("http"), F.get(F.split(href, r"\?"), F.lit(0)))
        .otherwise(blank_to_null(text))
    )
