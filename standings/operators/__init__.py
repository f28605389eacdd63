from standings.operators.allocation import allocate_pool, headcount_share
from standings.operators.balances import (
    adjusted_period_mean,
    adjusted_share,
    bucketed_sums,
    carried_write_offs,
    cumulative_by_period,
    cumulative_by_period_window,
    grouped_total,
    loan_months,
    loan_sums,
    merged_months,
    period_mean,
)
from standings.operators.ledger import (
    Line,
    account_months,
    account_totals,
    company_totals,
    gl_rollup,
    gl_rollup_long,
    line_map_frame,
    pool_row,
    proportional_cost,
)
from standings.operators.period import (
    month_spine,
    report_period,
    spine_of_period,
)
from standings.operators.ranking import (
    RankSpec,
    composite_rank,
    rank_distributed,
    rank_windowed,
)
from standings.operators.rowwise import mean_of_present, normalize_values, ratio_of_sums
from standings.operators.scoring import attach_metric, ratio_scorecard

__all__ = [
    "Line",
    "RankSpec",
    "account_months",
    "account_totals",
    "adjusted_period_mean",
    "adjusted_share",
    "allocate_pool",
    "attach_metric",
    "bucketed_sums",
    "carried_write_offs",
    "company_totals",
    "composite_rank",
    "cumulative_by_period",
    "cumulative_by_period_window",
    "gl_rollup",
    "gl_rollup_long",
    "grouped_total",
    "headcount_share",
    "line_map_frame",
    "loan_months",
    "loan_sums",
    "merged_months",
    "mean_of_present",
    "month_spine",
    "normalize_values",
    "period_mean",
    "pool_row",
    "proportional_cost",
    "rank_distributed",
    "rank_windowed",
    "ratio_of_sums",
    "ratio_scorecard",
    "report_period",
    "spine_of_period",
]
