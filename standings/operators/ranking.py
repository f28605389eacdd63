"""Ranks of any number of columns from one histogram of values; plain windows where a caller asks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from standings.sources.staging import Workspace

# A value is hot when it has more rows than both: so many, and this share of all. There are at most as
# many hot values as the share says, so what is broadcast of them has a fixed bound.
HOT_ROWS, HOT_SHARE = 100_000, 4096


@dataclass(frozen=True)
class RankSpec:
    """Rank rows on ``column``, ties sharing the smallest rank.

    NULLs rank first when ascending and last when descending, unless ``nulls`` says ``"first"``
    or ``"last"``; ``null_value`` replaces them beforehand. ``key`` maps the column to the value
    that is compared, for orders that are not the column's own.
    """

    column: str
    out: str
    descending: bool = False
    null_value: float | None = None
    key: Callable[[Column], Column] | None = None
    nulls: str | None = None

    @property
    def nulls_first(self) -> bool:
        return self.nulls == "first" if self.nulls else not self.descending

    def value(self) -> Column:
        col = F.col(self.column)
        if self.null_value is not None:
            col = F.coalesce(col, F.lit(self.null_value))
        return self.key(col) if self.key else col

    def order(self, value: Column) -> Column:
        if self.descending:
            return value.desc_nulls_first() if self.nulls_first else value.desc_nulls_last()
        return value.asc_nulls_first() if self.nulls_first else value.asc_nulls_last()


def rank_windowed(df: DataFrame, specs: Sequence[RankSpec], partition: Sequence[str] = ()) -> DataFrame:
    """Plain window ranks of any key. A whole group is sorted in one task: for groups known to be small."""
    ranks = {
        s.out: F.rank().over(_within(partition).orderBy(s.order(s.value()))).cast("bigint")
        for s in specs
    }
    return df.withColumns(ranks)


def _within(partition: Sequence[str]):
    return Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))


def rank_distributed(
    df: DataFrame,
    specs: Sequence[RankSpec],
    partition: Sequence[str] = (),
    workspace: Workspace | None = None,
) -> DataFrame:
    """The ranks of `rank_windowed`, with two exchanges of rows whatever the number of columns.

    Every row gives one (group, column, value) for each column to rank. These are counted map-side into a
    histogram, the histogram is cut into ranges of (group, column, value), and running sums within a range
    on top of the ranges before it give each value's rank. Ranks go back to the rows by value, the first
    exchange, and the columns of a row meet again, the second; the row itself travels with its first column.
    Rows of a hot value get its rank from a broadcast of at most ``HOT_SHARE`` values and are then dealt
    out by their own number, so no task gets all of them. No step needs a group, or a value, in one task.

    Any type that Spark can order and compare will do. ``df`` is read twice; it should be a stored table.
    """
    workspace = workspace or Workspace(df.sparkSession)
    melted = _melted(df, specs, partition)
    keys = [c for c in melted.columns if c not in ("_row", "_all")]
    ranks = _ranks_of_values(melted, specs, keys, workspace)
    rest = ranks.where("not _hot").select(*[F.col(c).alias(f"{c}_value") for c in keys], "_rank")
    found = _asking(melted, ranks, keys).join(rest, _same(keys, "_value"), "left").select(
        "_row", "_all", F.coalesce("_spec_hot", "_spec").alias("_column"), F.coalesce("_hot_rank", "_rank").alias("_rank")
    )
    each = [F.max(F.when(F.col("_column") == i, F.col("_rank"))).alias(s.out) for i, s in enumerate(specs)]
    # Dealt out first: a first aggregation before the exchange would sort all rows and join none.
    gathered = found.repartition("_row").groupBy("_row").agg(F.first("_all", ignorenulls=True).alias("_all"), *each)
    return gathered.select("_all.*", *[s.out for s in specs])


def _melted(df: DataFrame, specs: Sequence[RankSpec], partition: Sequence[str]) -> DataFrame:
    """(_row, _all, group, _spec, values): a row for each rank column; values of a type share a column."""
    kinds = [f.dataType for f in df.select(*[s.value().alias(s.out) for s in specs]).schema]
    types = list(dict.fromkeys(kinds))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    cells = []
    for number, (spec, kind) in enumerate(zip(specs, kinds)):
        values = [(spec.value() if t == kind else F.lit(None).cast(t)).alias(f"_v{i}") for i, t in enumerate(types)]
        carried = whole if number == 0 else F.lit(None).cast(df.schema)
        cells.append(F.struct(F.lit(number).alias("_spec"), *values, carried.alias("_all")))
    groups = [F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(partition)]
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), *groups, F.array(*cells).alias("_cells"))
    return numbered.select("_row", *[f"_g{i}" for i in range(len(groups))], F.inline("_cells"))


def _asking(melted: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """``melted`` with the ranks of hot values; rows that have theirs go by a column number of their own making."""
    hot = ranks.where("_hot").select(*[F.col(c).alias(f"{c}_hot") for c in keys], F.col("_rank").alias("_hot_rank"))
    spread = -1 - F.pmod(F.col("_row"), F.lit(HOT_SHARE)).cast("int")
    known = melted.join(F.broadcast(hot), _same(keys, "_hot"), "left")
    return known.withColumn("_spec", F.when(F.col("_hot_rank").isNull(), F.col("_spec")).otherwise(spread))


def _same(keys: Sequence[str], suffix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{c}{suffix}")) for c in keys]


def _ranks_of_values(melted: DataFrame, specs: Sequence[RankSpec], keys: list[str], workspace: Workspace) -> DataFrame:
    """(group, _spec, values, _rank, _hot) of every different value, as a staged table."""
    counts = melted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    slices = workspace.keep(
        counts.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), "value_counts"
    )
    groups, values = [c for c in keys if not c.startswith("_v")], [c for c in keys if c.startswith("_v")]
    missing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in values])
    group = Window.partitionBy(*groups)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        slices.groupBy(*groups, "_slice")
        .agg(F.sum("_rows").alias("_n"), F.sum(F.when(missing, F.col("_rows")).otherwise(0)).alias("_missing"))
        .select(
            *[F.col(c).alias(f"{c}_of") for c in groups],
            F.col("_slice").alias("_slice_of"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(group).alias("_all"),
            F.sum("_missing").over(group).alias("_nulls"),
        )
    )
    inside = Window.partitionBy(*groups, "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in values])
    within = F.coalesce(F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = slices.withColumn("_within", within).join(
        totals, [*_same(groups, "_of"), F.col("_slice") == F.col("_slice_of")]
    )
    # Missing values come first in the histogram, wherever they rank.
    smaller = F.col("_before") + F.col("_within") - F.col("_nulls")
    greater = F.col("_all") - F.col("_nulls") - smaller - F.col("_rows")
    descending = F.get(F.lit([s.descending for s in specs]), F.col("_spec"))
    nulls_first = F.get(F.lit([s.nulls_first for s in specs]), F.col("_spec"))
    better = F.when(descending, greater).otherwise(smaller) + F.when(nulls_first, F.col("_nulls")).otherwise(0)
    of_missing = F.when(nulls_first, 0).otherwise(F.col("_all") - F.col("_nulls"))
    rank = F.lit(1) + F.when(missing, of_missing).otherwise(better)
    share = slices.agg(F.sum("_rows")).scalar() / HOT_SHARE
    hot = (F.col("_rows") > HOT_ROWS) & (F.col("_rows") > share)
    return workspace.keep(placed.select(*keys, rank.cast("bigint").alias("_rank"), hot.alias("_hot")), "value_ranks")


def rank_sum(rank_cols: Sequence[str]) -> Column:
    """Sum of rank columns, NULL when one of them is."""
    return reduce(add, [F.col(c) for c in rank_cols])


def composite_rank(
    df: DataFrame,
    rank_cols: dict[str, Sequence[str]],
    partition: Sequence[str] = (),
    workspace: Workspace | None = None,
    nulls: str | None = None,
) -> DataFrame:
    """Rank the sums of other ranks, smallest first: ``rank_cols`` maps each output to its parts."""
    summed = df.withColumns({f"_{out}": rank_sum(cols) for out, cols in rank_cols.items()})
    specs = [RankSpec(f"_{out}", out, nulls=nulls) for out in rank_cols]
    return rank_distributed(summed, specs, partition, workspace).drop(*[s.column for s in specs])
