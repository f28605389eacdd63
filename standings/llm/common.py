"""Shared pieces of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.sources.staging import Workspace

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    r"""The words ``[^\x20\x09-\x0D]+`` of a text, in order; none for null."""
    return F.array_remove(F.split(whole(text), WORD_BREAK), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it.

    An expression named inside a lambda is evaluated again for every element; a lambda's own
    variable is not.
    """
    return F.transform(F.array(value), body)[0]


def listed(values: list[int]) -> Column:
    """A constant array of whole numbers; one literal, where ``lit`` would make one for each."""
    text = ",".join(map(str, values))
    return F.split(F.lit(text), ",").cast("array<bigint>")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Whole rows as the struct ``_row`` beside ``columns``, so that no input name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    return df.select("_row.*", *more)


def give_back() -> None:
    """Hands freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(batches: Iterable) -> Iterator:
    """The batches of a task in a Python worker, freed memory handed back after each.

    Workers live on and run other tasks beside the executor's own memory.
    """
    for batch in batches:
        yield batch
        del batch
        give_back()


class Stage(Workspace):
    """Intermediate tables under the folder that the cluster shares, zstd-compressed."""

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").options(**{"compression": "zstd"} | options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
