"""Loan tape operators: write-offs, balances by debt group, means over months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from standings.functions import MONEY_TOTAL, amount_total, ratio

# The channels left out of balances and write-offs.
EXCLUDED_CHANNELS = (4, 6)

# Which debt groups each balance adds up. A loan without a group counts as
# group 1, except in the 3-5 test, where it counts as none.
DEBT_GROUPS = {
    "balance_3_5": "max_bucket in (3, 4, 5)",
    "balance_1": "coalesce(max_bucket, 1) = 1",
    "balance_2": "coalesce(max_bucket, 1) = 2",
    "balance_2_5": "coalesce(max_bucket, 1) <> 1",
}
BALANCES = ["balance", *DEBT_GROUPS]
AMOUNTS = ["outstanding_principal", "write_off_balance_principal", "psdn"]


def in_channel(excluded=EXCLUDED_CHANNELS) -> Column:
    """True for the network's own channels; a missing channel is out as well."""
    return F.coalesce(~F.col("pos_type_key").isin(*excluded), F.lit(False))


def written_off_now() -> Column:
    """True in the month in which the loan is written off."""
    return F.coalesce(F.col("write_off_month") == F.col("kpi_month"), F.lit(False))


def bucketed_sums(df: DataFrame, keys, value: str, buckets: dict[str, str], total: str) -> DataFrame:
    """Total of ``value`` per key and, beside it, its part under each bucket's condition."""
    parts = {name: f"case when {test} then {value} else 0 end" for name, test in buckets.items()}
    return df.groupBy(*keys).agg(
        *[F.expr(amount_total(v)).alias(name) for name, v in {total: value, **parts}.items()]
    )


def cumulative_by_period(
    df: DataFrame, keys, period: str, value: str, spine: DataFrame, out: str, begin: int | None = None
) -> DataFrame:
    """Running total of ``value`` at every spine month, as a range join.

    ``df`` is added up per key and period before the join, and only the spine is broadcast:
    one row per calendar month. Without ``begin`` everything before the spine counts too.
    """
    if begin is not None:
        df = df.where(F.col(period) >= begin)
    monthly = df.groupBy(*keys, period).agg(F.expr(amount_total(value)).alias(out))
    reached = monthly.join(F.broadcast(spine), F.col(period) <= F.col("month_key"))
    return reached.groupBy("month_key", *keys).agg(F.expr(amount_total(out)).alias(out))


def cumulative_by_period_window(
    df: DataFrame, keys, period: str, value: str, months: list[int], out: str, begin: int | None = None
) -> DataFrame:
    """Same rows as `cumulative_by_period`, as a running sum: no join, so a spine of any length.

    Each key's running total holds until its next period; the months in between are filled in.
    """
    if begin is not None:
        df = df.where(F.col(period) >= begin)
    at = F.greatest(F.col(period), F.lit(months[0])).alias("at")
    monthly = df.where(F.col(period) <= months[-1]).groupBy(*keys, at).agg(
        F.expr(amount_total(value)).alias("moved")
    )
    by_key = Window.partitionBy(*keys).orderBy("at")
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = monthly.select(
        *keys,
        "at",
        F.lead("at").over(by_key).alias("until"),
        F.sum("moved").over(upto).cast(MONEY_TOTAL).alias(out),
    )
    held = F.filter(
        F.lit(months),
        lambda m: (m >= F.col("at")) & (F.col("until").isNull() | (m < F.col("until"))),
    )
    return running.select(F.explode(held).alias("month_key"), *keys, out)


def period_mean(df: DataFrame, keys, columns, prefix: str = "avg_") -> DataFrame:
    """Sum over the rows of a key by their number. A NULL adds nothing but still counts."""
    means = [F.expr(ratio(f"sum({c})", "count(1)")).alias(prefix + c) for c in columns]
    return df.groupBy(*keys).agg(*means)


def adjusted_period_mean(
    base: DataFrame, adjustment: DataFrame, on, column: str, keys, columns, prefix: str = "avg_"
) -> DataFrame:
    """`period_mean` after adding ``column`` of the matching adjustment row to every measure."""
    joined = base.join(adjustment, on, "left").selectExpr(
        *keys, *[f"{c} + coalesce({column}, 0) as {c}" for c in columns]
    )
    return period_mean(joined, keys, columns, prefix)


def adjusted_share(
    base: DataFrame, adjustment: DataFrame, on, column: str, num: str, den: str, out: str
) -> DataFrame:
    """``(num + x) * 100 / (den + x)`` with ``x`` taken from the matching adjustment row."""
    extra = f"coalesce({column}, 0)"
    share = ratio(f"({num} + {extra}) * 100", f"({den} + {extra})")
    return base.join(adjustment, on, "left").selectExpr(*on, f"{share} as {out}")


def grouped_total(
    df: DataFrame, keys, value: str, out: str, period: str, begin: int, end: int
) -> DataFrame:
    """Total of ``value`` per key over the months of the period."""
    return (
        df.where(F.col(period).between(begin, end))
        .groupBy(*keys)
        .agg(F.expr(amount_total(value)).alias(out))
    )


def loan_months(
    tape: DataFrame, begin: int, end: int, excluded=EXCLUDED_CHANNELS, after: int | None = None
) -> DataFrame:
    """The tape in one pass, added up to the finest grain the loan measures need.

    One row per branch, month, debt group and channel/write-off flag, so a handful per branch
    and month; the conditions on group, channel and write-off are then applied to those rows
    instead of to every loan. Months before ``begin`` matter to write-offs only, and those up to
    ``after`` not at all: their write-offs are known (`carried_write_offs`).
    """
    tape = tape.where(F.col("kpi_month") <= end)
    if after is not None:
        tape = tape.where(F.col("kpi_month") > after)
    return needed_months(loan_sums(tape, excluded), begin, end)


def loan_sums(tape: DataFrame, excluded=EXCLUDED_CHANNELS, keys: Sequence[str] = ()) -> DataFrame:
    """Every loan added up to the grain of `loan_months`; ``keys`` are further columns to keep apart."""
    rows = tape.select(
        *keys,
        "branch_city",
        "kpi_month",
        "max_bucket",
        in_channel(excluded).alias("in_channel"),
        (in_channel(excluded) & written_off_now()).alias("written_off"),
        *AMOUNTS,
    )
    return _added_up(rows, keys)


def needed_months(sums: DataFrame, begin: int, end: int) -> DataFrame:
    """What a report needs of `loan_sums`: its own months, and of earlier ones the write-offs."""
    return sums.where((F.col("kpi_month") <= end) & ((F.col("kpi_month") >= begin) | F.col("written_off")))


def merged_months(parts: DataFrame, begin: int, end: int) -> DataFrame:
    """`loan_months` from rows of `loan_sums` of any number of parts of the tape."""
    return _added_up(needed_months(parts, begin, end), ())


def _added_up(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "branch_city", "kpi_month", "max_bucket", "in_channel", "written_off").agg(
        *[F.expr(amount_total(c)).alias(c) for c in AMOUNTS]
    )


def carried_write_offs(new: DataFrame, state: DataFrame, through: int) -> DataFrame:
    """``new`` write-offs and all up to the month ``through``, which ``state`` holds per branch as that month's."""
    known = state.where(F.col("month_key") == through).select(
        "branch_city", F.col("month_key").alias("kpi_month"), F.col("writeoff_to_date").alias("write_off_balance_principal")
    )
    return new.where(F.col("kpi_month") > through).unionByName(known)


def write_offs(months: DataFrame) -> DataFrame:
    """The written-off amounts of `loan_months`, each in its own month."""
    return months.where("written_off").select("branch_city", "kpi_month", "write_off_balance_principal")


def branch_balances(months: DataFrame, begin: int, end: int) -> DataFrame:
    """Closing balances per branch and month, whole and by debt group."""
    scoped = months.where(F.col("in_channel") & F.col("kpi_month").between(begin, end))
    return bucketed_sums(
        scoped.withColumnRenamed("kpi_month", "month_key"),
        ["month_key", "branch_city"],
        "outstanding_principal",
        DEBT_GROUPS,
        total="balance",
    )
