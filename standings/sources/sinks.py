"""Sinks with the two load modes of the monthly job: whole table and whole month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.sources.files import delete_folder


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate-and-load."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(
    df: DataFrame, path: str, column: str = "month_key", months: Iterable[int] | None = None
) -> None:
    """Replace the partitions present in ``df`` and leave every other one alone.

    ``months`` are the partitions that a load stands for: those without rows in ``df`` are
    emptied, rows of others are not written. Running it twice leaves one copy. ``path`` must not be
    read by ``df`` itself. The rebalance hint gathers each month into few files and still splits
    a month too large for one task.
    """
    months = None if months is None else sorted(set(months))
    if months is not None:
        df = df.where(F.col(column).isin(months))
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    if months:
        filled = {r[0] for r in df.select(column).distinct().collect()}
        for month in months:
            if month not in filled:
                delete_folder(df.sparkSession, f"{path}/{column}={month}")

