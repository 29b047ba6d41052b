"""Official status, director and report status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmament import fixed_values as fv
from firmament.functions.normalize import blank_to_null, col, first_filled, strip

SEPARATOR = "|"


def map_provider_status(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.isin(fv.PROVIDER_STATUSES), c).otherwise(F.lit("UNKNOWN"))


def epoch_ms_to_date(c: Column | str) -> Column:
    """ISO date of an epoch-millisecond value; zero and null give null."""
    c = col(c)
    return F.when(c != 0, F.date_format(F.timestamp_millis(c), "yyyy-MM-dd"))


def infer_status(cessation: Column | str, head: Column | str) -> Column:
    """Status of a legal entity from its end date and the title of its head."""
    ended = F.coalesce(col(cessation), F.lit("")) != ""
    title = F.upper(F.coalesce(col(head), F.lit("")))
    bankrupt = F.lit(False)
    for word in fv.HEADS_BANKRUPT:
        bankrupt = bankrupt | title.contains(word)
    return (
        F.when(ended, F.lit("LIQUIDATED"))
        .when(title.contains(fv.HEAD_LIQUIDATOR), F.lit("LIQUIDATING"))
        .when(bankrupt, F.lit("BANKRUPT"))
        .otherwise(F.lit("ACTIVE"))
    )


def director_name(head: Column | str) -> Column:
    """Name after the first colon of ``title: name``; the whole text without a colon."""
    head = col(head)
    after = F.regexp_replace(head, r"(?s)^[^:]*:", "")
    return blank_to_null(strip(F.when(head.contains(":"), after).otherwise(head)))


def legal_name(full: Column | str, short: Column | str) -> Column:
    return F.coalesce(blank_to_null(full), col(short))


def report_status(status: Column | str, liquidation_date: Column | str, inn: Column | str) -> Column:
    """``STATUS|date``, ``STATUS``, ``NO_INN`` or ``PENDING``."""
    status, when_, inn = col(status), col(liquidation_date), col(inn)
    return (
        F.when(status.isNotNull(), F.concat_ws(SEPARATOR, status, when_))
        .when(inn.isNull(), F.lit("NO_INN"))
        .otherwise(F.lit("PENDING"))
    )


def status_code(c: Column | str) -> Column:
    return blank_to_null(F.substring_index(col(c), SEPARATOR, 1))


def status_label(c: Column | str, labels: dict[str, str] = fv.STATUS_LABELS) -> Column:
    """Readable label, followed by the date on a second line when there is one."""
    c = col(c)
    code = status_code(c)
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    label = F.coalesce(F.try_element_at(known, code), code)
    date = blank_to_null(F.when(c.contains(SEPARATOR), F.regexp_replace(c, r"(?s)^[^|]*\|", "")))
    return F.when(label.isNotNull(), F.concat_ws("\n", label, date))


__all__ = [
    "director_name",
    "epoch_ms_to_date",
    "first_filled",
    "infer_status",
    "legal_name",
    "map_provider_status",
    "report_status",
    "status_code",
    "status_label",
]
