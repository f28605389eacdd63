"""Scorecards: a metric attached to staff, ratios computed per branch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from standings.functions import ratio, rounded


def attach_metric(staff: DataFrame, metric: DataFrame, on) -> DataFrame:
    """Staff rows with the metric of their month and province; NULL where there is none."""
    return staff.join(metric, on, "left")


def ratio_scorecard(branches: DataFrame, components) -> DataFrame:
    """The four financial ratios of every branch.

    ``components`` lists ``(frame, key)`` pairs that bring ``opex``, ``card``, ``fund``,
    ``other``, ``other_revenue``, ``provision`` and ``heads``; what is missing counts as 0.
    """
    for frame, key in components:
        branches = branches.join(frame, key, "left")

    names = ("opex", "card", "fund", "other", "other_revenue", "provision", "heads")
    parts = branches.selectExpr(
        "dd",
        "province as branch_city",
        *[f"coalesce(cast({name} as double), 0) as {name}" for name in names],
    )
    profit = rounded("card + opex + provision")
    return parts.selectExpr(
        "dd",
        "branch_city",
        ratio("opex * -100", rounded("card + fund + other")) + " as cir",
        ratio(f"{profit} * 100", rounded("card + other_revenue")) + " as margin",
        ratio(f"{profit} * -100", "fund") + " as return_on_funding",
        ratio(profit, "heads") + " as profit_per_head",
    )
