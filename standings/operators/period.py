"""Report period and month spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.functions import first_day


def report_period(df: DataFrame, month_col: str, year: int | None = None) -> DataFrame:
    """One row ``(begin_month, end_month)``: the latest month and the January before it.

    ``year`` pins the January to another year.
    """
    latest = df.agg(F.max(month_col).cast("int").alias("end_month"))
    january = F.lit(year * 100 + 1) if year else F.floor(F.col("end_month") / 100) * 100 + 1
    return latest.select(january.cast("int").alias("begin_month"), "end_month")


def month_spine(spark: SparkSession, begin: int, end: int) -> DataFrame:
    """Every calendar month from ``begin`` to ``end`` as ``month_key``."""
    bounds = spark.range(1).select(
        F.lit(first_day(begin)).alias("first"), F.lit(first_day(end)).alias("last")
    )
    return _months_between(bounds, F.col("first"), F.col("last"))


def spine_of_period(period: DataFrame) -> DataFrame:
    """The spine of a `report_period` row, without fetching the row to the driver."""

    def day(name):
        return F.make_date(F.floor(F.col(name) / 100), F.col(name) % 100, F.lit(1))

    return _months_between(period, day("begin_month"), day("end_month"))


def _months_between(df: DataFrame, first, last) -> DataFrame:
    days = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return df.select(days.alias("day")).select(
        (F.year("day") * 100 + F.month("day")).cast("int").alias("month_key")
    )
