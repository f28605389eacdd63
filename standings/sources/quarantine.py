"""Rows that do not fit their schema, set aside with the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from standings.sources.schemas import checked_names

REJECTED = "input string, reasons array<string>, row string"


def _reasons(df: DataFrame, schema: StructType) -> Column:
    """A text for each column whose value cannot be cast; none for a row that fits."""
    present = {f.name.lower(): f.dataType for f in df.schema}
    tests = []
    for field in schema:
        if present[field.name.lower()] == field.dataType:
            continue
        value, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        failed = value.isNotNull() & value.try_cast(field.dataType).isNull()
        shown = F.coalesce(value.try_cast("string"), F.lit("?"))
        tests.append(F.when(failed, F.concat(F.lit(f"{field.name}: "), shown, F.lit(f" is no {kind}"))))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def fitting_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows of ``df`` whose values can all be cast to ``schema``."""
    checked_names(df, schema)
    return df.where(F.size(_reasons(df, schema)) == 0)


def rejected_rows(df: DataFrame, schema: StructType, name: str) -> DataFrame:
    """(input, reasons, row) of the other rows of the input ``name``, each whole as JSON."""
    checked_names(df, schema)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    found = df.select(F.lit(name).alias("input"), _reasons(df, schema).alias("reasons"), whole.alias("row"))
    return found.where(F.size("reasons") > 0)
