from standings.functions.months import (
    first_day,
    month_list,
    month_of,
    next_month,
    year_start,
)
from standings.functions.sql import (
    MONEY,
    MONEY_TOTAL,
    SCALE,
    amount_total,
    exact_total,
    plus,
    quoted,
    ratio,
    rounded,
    total_or_zero,
)

__all__ = [
    "MONEY",
    "MONEY_TOTAL",
    "SCALE",
    "amount_total",
    "exact_total",
    "first_day",
    "month_list",
    "month_of",
    "next_month",
    "plus",
    "quoted",
    "ratio",
    "rounded",
    "total_or_zero",
    "year_start",
]
