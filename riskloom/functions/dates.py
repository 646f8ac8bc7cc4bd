"""Date parsing, calendar parts and day gaps as column expressions.

Everything is ``timestamp_ntz``: the raw tables carry wall-clock text without
a zone, and the result must not depend on the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp(text: Column) -> Column:
    """Free-form date text to ``timestamp_ntz``; null when it is no date.

    Accepted: ISO date or date-time, ``Y/M/D`` or ``Y.M.D`` with or without a
    time, and compact ``YYYYMMDD``.
    """
    trimmed = F.trim(text)
    dashed = F.regexp_replace(trimmed, r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3")
    iso = F.regexp_replace(dashed, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return iso.try_cast("timestamp_ntz")


def parse_day(text: Column) -> Column:
    """Only the date part of the first ten characters; a time of day is dropped."""
    day = F.regexp_replace(F.substring(F.trim(text), 1, 10), "[ T].*$", "")
    return parse_timestamp(day).cast("date").cast("timestamp_ntz")


def parse_slash_date(text: Column) -> Column:
    """Strict ``Y/M/D``; anything else becomes null."""
    parts = F.when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.replace(text, F.lit("/"), F.lit("-")))
    return parts.try_cast("timestamp_ntz")


def date_parts(date: Column, prefix: str) -> dict[str, Column]:
    """``<prefix>_year``, ``_month`` and ``_day``."""
    return {
        f"{prefix}_year": F.year(date),
        f"{prefix}_month": F.month(date),
        f"{prefix}_day": F.dayofmonth(date),
    }


def day_gap(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down; null if either is.

    One hour backwards is -1 day, which ``datediff`` would call 0: the day
    difference is one less when the end's time of day is the earlier one. No
    step looks at a time zone.
    """
    days = F.date_diff(end.cast("date"), start.cast("date"))
    ends_earlier = start + F.make_dt_interval(days) > end
    return (days - F.when(ends_earlier, 1).otherwise(0)).cast("bigint")
