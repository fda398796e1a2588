"""Date expressions. Count dates travel as ``yyyyMMdd`` text, whose order is the date order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def parse_date(c: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Date, or null when the text does not fit the format or is no calendar day."""
    return F.try_to_date(_col(c), fmt)


def date_key(c: Column | str, fmt: str | None = None) -> Column:
    """``yyyyMMdd`` text of a date/timestamp column, or of text in format ``fmt``."""
    c = parse_date(c, fmt) if fmt else _col(c)
    return F.date_format(c, "yyyyMMdd")


def weekday_date(c: Column | str, month_first: Column | bool = False) -> Column:
    """``Monday 01/06/2026``: the weekday name is dropped, the rest read day or month first."""
    rest = F.regexp_extract(_col(c), r"(?i)^\s*(?:mon|tues|wednes|thurs|fri|satur|sun)day\s+(\S+)\s*$", 1)
    day_first_value = F.try_to_date(rest, "d/M/yyyy")
    month_first_value = F.try_to_date(rest, "M/d/yyyy")
    if isinstance(month_first, bool):
        return month_first_value if month_first else day_first_value
    return F.when(month_first, month_first_value).otherwise(day_first_value)


def shift_hours(ts: Column | str, hours: int = 7) -> Column:
    return _col(ts) + F.make_interval(hours=F.lit(hours))


def year_of(c: Column | str) -> Column:
    return F.left(_col(c), F.lit(4))


def weekday_number(d: Column | str) -> Column:
    """Number of Mondays to Fridays from 1970-01-05 (a Monday) up to, without, ``d``."""
    days = F.datediff(_col(d), F.lit("1970-01-05").cast("date"))
    weeks = F.floor(days / F.lit(7)).cast("int")
    rest = days - weeks * 7
    return weeks * 5 + F.least(rest, F.lit(5))


def age_bucket(n: Column | str) -> Column:
    """Right-closed bins from above -1; null outside them."""
    n = _col(n)
    # Upper bounds and labels of the posting-age report.
    bins = [
        (1, "G 0-1"),
        (3, "G 2-3"),
        (5, "G 4-5"),
        (7, "G 6-7"),
        (9, "G 8-9"),
        (15, "G 10-15"),
        (30, "G 16-30"),
    ]
    label = F.when(n <= -1, F.lit(None).cast("string"))
    for upper, text in bins:
        label = label.when(n <= upper, text)
    return label.when(n > 30, "G >30")
