"""Operators that look at one row at a time; none of them shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standings.functions import ratio, total_or_zero


def normalize_values(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Rename values of ``column``; the source table stays as it is."""
    return df.replace(mapping, subset=[column]) if mapping else df


def mean_of_present(df: DataFrame, columns, out: str) -> DataFrame:
    """Mean over the columns that are not NULL; NULL when all are."""
    present = " + ".join(f"int({c} is not null)" for c in columns)
    return df.withColumn(out, F.expr(ratio(total_or_zero(columns), present)))


def ratio_of_sums(df: DataFrame, num, den, out: str, scale: int = 100, on_zero=0) -> DataFrame:
    """``scale * sum(num) / sum(den)`` over the columns of a row, ``on_zero`` without any ``den``."""
    below = total_or_zero(den)
    share = ratio(f"{scale} * {total_or_zero(num)}", below)
    return df.withColumn(
        out, F.expr(f"case when {below} = 0 then cast({on_zero} as double) else {share} end")
    )
