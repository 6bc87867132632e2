"""Month arithmetic on first-of-month dates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: Column | date | str) -> Column:
    """A Column as it is; an ISO string or a date as a ``DateType`` literal."""
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def months_before(as_of: Column, c: Column) -> Column:
    """Whole calendar months from ``c`` up to ``as_of``, days of the month ignored."""
    return (F.year(as_of) - F.year(c)) * 12 + (F.month(as_of) - F.month(c))


def listed_months(lo: str | date, hi: str | date) -> list[date]:
    """First days of all months from that of ``lo`` to that of ``hi``."""
    lo, hi = (d if isinstance(d, date) else date.fromisoformat(d) for d in (lo, hi))
    first, last = lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(first, last + 1)]


def later_months(months: Iterable[date], steps: Iterable[int]) -> set[date]:
    """Every month moved on by each of ``steps``."""
    moved = {m.year * 12 + m.month - 1 + s for m in months for s in steps}
    return {date(m // 12, m % 12 + 1, 1) for m in moved}
