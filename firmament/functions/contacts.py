"""Phone and e-mail forms found on company websites."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.normalize import col, digits, let, strip


def format_phone(c: Column | str) -> Column:
    """``+7 (XXX) XXX-XX-XX`` for ten digits or eleven that start with 7 or 8, else null."""
    national = let(
        digits(c),
        lambda d: F.when(d.rlike("^[78][0-9]{10}$"), F.substring(d, 2, 10)).when(F.length(d) == 10, d),
    )
    return F.regexp_replace(national, r"^(\d{3})(\d{3})(\d{2})(\d{2})$", r"+7 ($1) $2-$3-$4")


def _alternatives(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def is_valid_email(
    c: Column | str,
    junk_local_parts: list[str] = fv.JUNK_LOCAL_PARTS,
    junk_domains: list[str] = fv.JUNK_DOMAINS,
    file_extensions: list[str] = fv.FILE_EXTENSIONS,
) -> Column:
    """One ``@``, dotted domain, sane lengths, no file name and no junk address."""

    def judge(email):
        local = F.substring_index(email, "@", 1)
        domain = F.substring_index(email, "@", -1)
        ok = (
            email.rlike(r"(?s)^[^@]+@[^@]+\z")
            & domain.contains(".")
            & (F.length(local) <= 64)
            & (F.length(domain) <= 255)
        )
        if file_extensions:
            ok = ok & ~email.rlike(rf"(?s)(?:{_alternatives(file_extensions)})\z")
        if junk_local_parts:
            ok = ok & ~local.isin(junk_local_parts)
        if junk_domains:
            ok = ok & ~domain.rlike(rf"(?s)(?:^|\.)(?:{_alternatives(junk_domains)})\z")
        return ok

    return F.coalesce(let(F.lower(strip(c)), judge), F.lit(False))


def decode_protected_email(c: Column | str) -> Column:
    """Undo the XOR protection of an address: the first hex byte is the key."""

    def decode(code):
        key = F.conv(F.substring(code, 1, 2), 16, 10).cast("int")
        chars = F.transform(
            F.sequence(F.lit(3), F.length(code), F.lit(2)),
            lambda i: F.char(
                F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int").bitwiseXOR(key)
            ),
        )
        return F.when(code.rlike(r"^[0-9a-fA-F]{3,}\z"), F.array_join(chars, ""))

    return let(col(c), decode)
