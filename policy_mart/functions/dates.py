"""Date columns: month numbers, month starts, dates from parts, date windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, lenient_date

MONTH = "yyyymm"


def yyyymm(c: Column | str) -> Column:
    return (F.year(_col(c)) * 100 + F.month(_col(c))).cast("int")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def month_number(d: dt.date) -> int:
    return d.year * 100 + d.month


def month_index(month: Column | str) -> Column:
    """Consecutive number of a yyyymm month, so that neighbours differ by one."""
    m = _col(month)
    return F.floor(m / 100).cast("int") * 12 + m % 100


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from three integer columns; impossible dates (0-0-0, 31 February) become null."""
    parts = [_col(p).cast("string") for p in (year, month, day)]
    return lenient_date(F.concat_ws("-", *parts), "yyyy-M-d")


def null_year_one(c: Column | str) -> Column:
    """Year 1 is the source's placeholder for an unknown date."""
    return F.when(F.year(_col(c)) != 1, _col(c))


def in_month(c: Column | str, year: int, month: int) -> Column:
    """A half-open range, which reaches the scan as a pushed filter (year()/month() would not)."""
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return (_col(c) >= F.lit(first)) & (_col(c) < F.lit(after))


def from_month(year: Column | str, month: Column | str, since: dt.date) -> Column:
    """Year and month columns not before `since`'s month, as comparisons that sources can evaluate."""
    later = _col(year) > since.year
    return later | ((_col(year) == since.year) & (_col(month) >= since.month))


def days_back(c: Column | str, until: dt.date, days: int) -> Column:
    """`until - days <= c <= until`, both ends included."""
    return _col(c).between(F.lit(until - dt.timedelta(days=days)), F.lit(until))
