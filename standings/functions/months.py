"""Calendar months as ``YYYYMM`` integers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_start(month: int) -> int:
    return month // 100 * 100 + 1


def next_month(month: int) -> int:
    return month + 1 if month % 100 < 12 else (month // 100 + 1) * 100 + 1


def first_day(month: int) -> date:
    return date(month // 100, month % 100, 1)


def month_list(begin: int, end: int) -> list[int]:
    """Every calendar month from ``begin`` to ``end``, both included."""
    first, last = (m // 100 * 12 + m % 100 - 1 for m in (begin, end))
    return [i // 12 * 100 + i % 12 + 1 for i in range(first, last + 1)]


def month_of(when: Column) -> Column:
    return F.year(when) * 100 + F.month(when)
