"""SQL expressions the operators share: exact sums and divisions that never fail.

They take and return expression text. A line or a metric is often a dozen terms long, and as
text it is one call into the JVM instead of one per term.
"""

from __future__ import annotations

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"

# Digits kept after every division. Ranks are taken on the rounded value, so that two equal
# ratios reached through different additions still tie.
SCALE = 6


def rounded(value: str, scale: int = SCALE) -> str:
    return f"round({value}, {scale})"


def ratio(num: str, den: str, scale: int = SCALE) -> str:
    """``num / den`` as a rounded double; NULL when either side is NULL or ``den`` is 0."""
    return rounded(f"try_divide(cast({num} as double), cast({den} as double))", scale)


def amount_total(value: str) -> str:
    """Sum of money amounts. Decimal, so the order of addition cannot change it."""
    return f"cast(sum({value}) as {MONEY_TOTAL})"


def exact_total(value: str) -> str:
    """Sum of already rounded doubles, added up as decimals to stay order-independent."""
    return f"cast(sum(cast({value} as decimal(38,{SCALE}))) as double)"


def total_or_zero(columns) -> str:
    """Row-wise sum of columns with NULL read as 0."""
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in columns) + ")"


def plus(columns) -> str:
    """Row-wise sum of columns, NULL as soon as one of them is NULL."""
    return "(" + " + ".join(columns) + ")"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
