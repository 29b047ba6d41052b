"""Normalisation of scalar and list fields of a company record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmament import fixed_values as fv


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A higher-order function re-evaluates whatever its lambda mentions for every
    element; going through a one-element array keeps that to a single time.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Trim Unicode white space; ``F.trim`` would only remove U+0020."""
    return F.btrim(col(c), F.lit(fv.WHITE_SPACE))


def blank_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(c != "", c)


def first_filled(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def normalize_website(c: Column | str) -> Column:
    """Host and path in lower case without scheme, ``www.`` and trailing slashes."""
    v = F.lower(strip(c))
    v = F.regexp_replace(v, r"^(https://)?(http://)?(www\.)?", "")
    return blank_to_null(F.regexp_replace(v, r"/+\z", ""))


def normalize_name(c: Column | str) -> Column:
    """Comparison form of a company name: case, quotes, dashes and punctuation removed."""
    dashes = " " * len(fv.NAME_DASHES)
    v = F.translate(F.lower(strip(c)), fv.NAME_DASHES + fv.NAME_DROPPED, dashes)
    return strip(F.regexp_replace(v, r"(?U)\s+", " "))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def clean_numeric(c: Column | str) -> Column:
    return blank_to_null(digits(c))


def with_length(c: Column, lengths: list[int]) -> Column:
    return F.when(F.length(c).isin(lengths), c)


def clean_inn(c: Column | str) -> Column:
    return with_length(clean_numeric(c), fv.INN_LENGTHS)


def clean_ogrn(c: Column | str) -> Column:
    return with_length(clean_numeric(c), fv.OGRN_LENGTHS)


def as_list(c: Column | str) -> Column:
    """Scalar string to a list: blank or null gives an empty list."""
    c = col(c)
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(strip(c), F.lit("")) != "", F.array(c)).otherwise(empty)


def list_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.array().cast("array<string>"))


def strip_phone_annotation(c: Column | str) -> Column:
    """Drop a trailing bracket that holds a letter, such as ``(fax)``."""
    return F.regexp_replace(col(c), "(?U)" + fv.PHONE_ANNOTATION_PATTERN, "")


def phone_fingerprint(c: Column | str, unify_prefix: bool = False) -> Column:
    """Digits of a phone number; ``unify_prefix`` also reads a leading 8 as 7."""
    fp = digits(c)
    if unify_prefix:
        fp = F.when(fp.rlike("^8[0-9]{10}$"), F.concat(F.lit("7"), F.substring(fp, 2, 10))).otherwise(fp)
    return fp


def usable_fingerprint(fp: Column) -> Column:
    return F.length(fp) >= fv.MIN_PHONE_DIGITS


def dedup_phones(c: Column | str) -> Column:
    """Annotation-free phones, first one per fingerprint, order kept."""

    def entry(raw):
        return let(strip(raw), lambda s: let(
            strip(strip_phone_annotation(s)),
            lambda clean: let(
                F.when(clean != "", clean).otherwise(s),
                lambda shown: F.struct(digits(shown).alias("fp"), shown.alias("phone")),
            ),
        ))

    entries = F.filter(
        F.transform(list_or_empty(c), entry),
        lambda e: usable_fingerprint(e["fp"]),
    )
    return let(
        entries,
        lambda es: F.transform(
            F.filter(es, lambda e, i: F.array_position(es["fp"], e["fp"]) == i + 1),
            lambda e: e["phone"],
        ),
    )


def fingerprints(c: Column | str, unify_prefix: bool = False) -> Column:
    """Distinct usable fingerprints of a phone list."""
    return F.array_distinct(
        F.filter(
            F.transform(list_or_empty(c), lambda p: phone_fingerprint(p, unify_prefix)),
            usable_fingerprint,
        )
    )


def canonical_email(c: Column | str) -> Column:
    return blank_to_null(F.lower(strip(c)))


def dedup_emails(c: Column | str) -> Column:
    return F.array_distinct(F.array_compact(F.transform(list_or_empty(c), canonical_email)))


def clean_kpp_list(c: Column | str) -> Column:
    return F.array_distinct(
        F.filter(F.transform(list_or_empty(c), digits), lambda k: F.length(k) == fv.KPP_LENGTH)
    )


def last_seen(last_seen_at: Column | str, scrape_date: Column | str) -> Column:
    return F.coalesce(col(last_seen_at), col(scrape_date))


def dotted_to_iso(c: Column | str) -> Column:
    """``DD.MM.YYYY`` to ``YYYY-MM-DD``; anything else is returned unchanged."""
    c = col(c)
    parts = F.split(strip(c), r"\.")
    return F.when(
        strip(c).rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\z"),
        F.concat_ws("-", F.get(parts, F.lit(2)), F.get(parts, F.lit(1)), F.get(parts, F.lit(0))),
    ).otherwise(c)


def parse_date(c: Column | str, formats: list[str] = fv.DATE_FORMATS) -> Column:
    """Date by the first format that fits the whole text, else null."""
    c = col(c)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in formats])


def contact_summary(phones: Column | str, emails: Column | str, kpps: Column | str) -> Column:
    """Short count text; parts that are empty are left out."""
    parts = [("тел", phones), ("email", emails), ("кпп", kpps)]
    text = F.concat_ws(
        " ",
        *[
            F.when(F.size(list_or_empty(c)) > 0, F.concat(F.lit(f"{tag}:"), F.size(list_or_empty(c)).cast("string")))
            for tag, c in parts
        ],
    )
    return F.when(text != "", F.concat(F.lit("["), text, F.lit("]"))).otherwise(F.lit(""))
