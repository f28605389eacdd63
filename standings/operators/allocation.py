"""Spreading a head-office pool over branches in proportion to a driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.functions import exact_total, rounded

KEEP_DIRECT = "keep_direct"
ZERO_ALL = "zero_all"


def headcount_share(staff: DataFrame, key: str = "province", total: bool = True) -> DataFrame:
    """Rows per key as ``heads`` and, on request, over all keys as ``total_heads``."""
    heads = staff.groupBy(key).agg(F.count(F.lit(1)).alias("heads"))
    if not total:
        return heads
    return heads.withColumn("total_heads", heads.agg(F.sum("heads")).scalar())


def allocate_pool(
    base: DataFrame,
    pool: Column,
    drivers: DataFrame,
    on: str,
    lines: dict[str, str],
    null_policy: str = KEEP_DIRECT,
    require_pool: bool = True,
) -> DataFrame:
    """``direct + pool * driver / sum(driver)`` for every line of ``base``.

    ``lines`` names the driver column of each line. ``pool`` is a one-row struct with a field
    per line, such as `pool_row` gives. It and the driver totals are scalar subqueries, which
    Spark runs once for all the allocations that share them.

    ``keep_direct`` adds nothing where the share is unknown. ``zero_all`` makes the whole line 0
    there, direct amount included. ``require_pool`` returns no rows at all without a pool.
    """
    columns = [c for c in drivers.columns if c != on]
    totals = drivers.select(F.struct(*[F.expr(exact_total(c)).alias(c) for c in columns])).scalar()
    joined = base.join(drivers, on, "left").withColumns({"_pool": pool, "_total": totals})
    if require_pool:
        joined = joined.where(F.col("_pool").isNotNull())

    def allocated(line, driver):
        direct = f"cast({line} as double)"
        share = f"try_divide(cast(_pool.{line} as double) * cast({driver} as double), _total.{driver})"
        if null_policy == ZERO_ALL:
            value = f"coalesce(coalesce({direct}, 0) + {share}, 0)"
        else:
            value = f"{direct} + coalesce({share}, 0)"
        return f"{rounded(value)} as {line}"

    kept = [c for c in base.columns if c not in lines]
    return joined.selectExpr(*kept, *[allocated(line, driver) for line, driver in lines.items()])


def allocation_audit(
    direct: DataFrame, pool: DataFrame, drivers: DataFrame, allocated: DataFrame, on: str, lines: dict[str, str]
) -> DataFrame:
    """What became of each line's money: (line, direct, pool, allocated, difference, unmatched).

    ``direct`` and ``allocated`` are the two sides of an allocation over the rows kept, ``pool`` its pool row, if
    any. ``difference`` is what went missing or was made; ``unmatched`` names those that have a share of the
    line's driver but no row to get it. All tables have some rows for each branch.
    """

    def by_line(df, name):
        sums = df.agg(*[F.expr(exact_total(f"cast({line} as double)")).alias(line) for line in lines])
        return sums.unpivot([], list(lines), "line", name)

    kept = direct.select(on).distinct()
    columns = list(dict.fromkeys(lines.values()))
    left_out = drivers.join(kept, on, "left_anti").select(on, *[F.col(c).cast("double").alias(c) for c in columns])
    unmatched = (
        left_out.unpivot([on], columns, "driver", "share")
        .where("share <> 0")
        .groupBy("driver")
        .agg(F.array_sort(F.collect_list(on)).alias("unmatched"))
    )
    driver = F.create_map(*[F.lit(x) for pair in lines.items() for x in pair])[F.col("line")]
    joined = by_line(direct, "direct").join(by_line(allocated, "allocated"), "line").join(by_line(pool, "pool"), "line")
    parts = [f"coalesce({c}, 0)" for c in ("allocated", "direct", "pool")]
    return (
        joined.withColumn("driver", driver)
        .join(unmatched, "driver", "left")
        .selectExpr(
            "line",
            "direct",
            "pool",
            "allocated",
            rounded(f"{parts[0]} - {parts[1]} - {parts[2]}") + " as difference",
            "coalesce(unmatched, cast(array() as array<string>)) as unmatched",
        )
    )
