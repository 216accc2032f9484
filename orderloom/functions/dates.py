"""Calendar and time functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names shown in Vietnamese reports.
MONTH_NAMES_VI = [
    "Tháng 1", "Tháng 2", "Tháng 3", "Tháng 4", "Tháng 5", "Tháng 6",
    "Tháng 7", "Tháng 8", "Tháng 9", "Tháng 10", "Tháng 11", "Tháng 12",
]
# Sunday first.
DAY_NAMES_VI = ["Chủ Nhật", "Thứ Hai", "Thứ Ba", "Thứ Tư", "Thứ Năm", "Thứ Sáu", "Thứ Bảy"]


def pick(index: Column, values: list[str]) -> Column:
    """The 1-based ``index``-th value, NULL when out of range."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), index)


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic so that it stays in generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_to_date(key: Column) -> Column:
    return F.make_date((key / 10000).cast("int"), ((key / 100).cast("int") % 100), key % 100)


def _instant(value: dt.datetime | dt.date) -> Column:
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return instant(value.isoformat(sep=" "))


def instant(text: str) -> Column:
    """A zone-less timestamp literal such as ``2001-08-02 00:00:00``."""
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def between_half_open(column: Column, start, stop) -> Column:
    """``start <= column < stop``; unlike a function of the column it reaches the file scan."""
    return (column >= _instant(start)) & (column < _instant(stop))


def year_range(column: Column, year: int) -> Column:
    return between_half_open(column, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def week_monday_first(day: Column) -> Column:
    """Week 0-53, Monday first: days before the first four-day week are week 0."""
    return F.floor((F.dayofyear(day) - iso_weekday(day) + 10) / 7).cast("int")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def fiscal_year(day: Column, start_month: int = 4) -> Column:
    """Year in which the fiscal year starting in ``start_month`` began."""
    return F.year(day) - (F.month(day) < start_month).cast("int")


def fiscal_quarter(day: Column, start_month: int = 4) -> Column:
    return (F.floor(F.pmod(F.month(day) - start_month, F.lit(12)) / 3) + 1).cast("int")


def whole_units(unit: str, start: Column, stop: Column) -> Column:
    """Completed ``unit``s from ``start`` to ``stop``."""
    return F.timestamp_diff(unit, start, stop)


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)
