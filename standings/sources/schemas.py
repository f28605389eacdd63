"""Input schemas, matched by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INT, LONG, MONEY = StringType(), IntegerType(), LongType(), DecimalType(18, 2)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


LOAN_TAPE = _schema(
    branch_city=TEXT,
    kpi_month=INT,
    write_off_month=INT,
    write_off_balance_principal=MONEY,
    outstanding_principal=MONEY,
    max_bucket=INT,
    pos_type_key=LONG,
    psdn=MONEY,
)
LEDGER = _schema(
    analysis_code=TEXT, account_code=TEXT, amount=MONEY, transaction_date=TimestampNTZType()
)
PROVINCES = _schema(dd=TEXT, province=TEXT)
FUNDING = _schema(branch_city=TEXT, cost_deposit_cert=MONEY, cost_market_1=MONEY, cost_market_2=MONEY)
# Columns that hold the name of a branch.
NAMES = {"province", "branch_city"}
LINE_MAP = _schema(line=TEXT, match_kind=TEXT, pattern=TEXT)


def month_columns(metric: str, months: int) -> list[str]:
    return [f"{metric}_{m:02d}" for m in range(1, months + 1)]


def sales_schema(months: int = 5) -> StructType:
    """The wide sales sheet: one column per metric and month, NULL for no activity."""
    cells = {
        column: kind
        for metric, kind in (("ltn", MONEY), ("psdn", MONEY), ("appin", LONG), ("approved", LONG))
        for column in month_columns(metric, months)
    }
    return _schema(month_key=INT, province=TEXT, staff_code=TEXT, **cells)


def conform(df: DataFrame, schema: StructType, collation: str | None = None, keep: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """Select the columns of ``schema`` by name and cast them, and those of ``keep``; fail when one is missing.

    ``collation`` (``"UNICODE_CI_AI"``, say) makes province and branch names compare that way
    in the joins and groupings that follow. The default compares bytes. Names are trimmed. ``lenient``
    makes NULL of what cannot be cast, for rows that `fitting_rows` has let through.
    """
    checked_names(df, schema)
    picked = []
    for field in schema:
        col = F.col(field.name)
        col = col.try_cast(field.dataType) if lenient else col.cast(field.dataType)
        if field.name in NAMES:
            col = F.trim(col)
            if collation:
                col = F.collate(col, collation)
        picked.append(col.alias(field.name))
    return df.select(*keep, *picked)


def checked_names(df: DataFrame, schema: StructType) -> None:
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
