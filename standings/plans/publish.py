"""The monthly job: compute one month's report and load every table it produces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from standings.plans.report import RankingInputs, RankingRun
from standings.sources.schemas import FUNDING
from standings.sources.snapshots import CatalogSnapshots, SnapshotSet
from standings.sources.staging import Workspace, inputs_key

# Names of the inputs, in the order of `RankingInputs`.
INPUTS = ("sales_wide", "loan_tape", "gl", "province_dim", "funding_cost_branch")

# Tables that keep their history: a run replaces the months it computed.
BY_MONTH = {"staff_averages": "averages", "staff_scorecard": "scorecard", "writeoff_state": "carried_writeoff"}

# Tables a run replaces as a whole.
WHOLE = {
    "month_spine": "spine",
    "writeoff_to_date": "writeoff",
    "branch_balances": "balances",
    "mean_balances": "mean_balances",
    "mean_balances_before_writeoff": "mean_balances_before_writeoff",
    "branch_volume": "volume",
    "opex_allocated": "opex",
    "card_revenue": "card_direct",
    "card_revenue_allocated": "card",
    "other_cost": "other_direct",
    "other_cost_allocated": "other",
    "provision_cost": "provision_direct",
    "provision_allocated": "provision",
    "funding_cost_pool": "funding_pool",
    "financial_ratios": "ratios",
    "ranking_report": "report",
}


def publish(run: RankingRun, target: str, catalog: bool = False, audit: bool = False) -> int:
    """Load the tables of ``run`` under ``target``; a second run of a month changes nothing.

    ``target`` is a folder, or with ``catalog`` a database. All tables are written beside the published
    ones, then one commit shows them: readers (`published`, or the views of the database) see the whole old
    report or the whole new one, and a failure at any point leaves the old one. The months that the
    run stands for are emptied if it has no rows for them. With ``audit`` nothing is published when an
    allocation loses money, and ``allocation_audit`` shows what became of it. A lenient run publishes the
    ``rejected_rows`` as well, for one more pass over its inputs. Returns the version.
    """
    spark = run.inputs.sales.sparkSession
    workspace = run.workspace or Workspace(spark)
    try:
        whole = {name: getattr(run, attribute) for name, attribute in WHOLE.items()}
        by_month = {name: getattr(run, attribute) for name, attribute in BY_MONTH.items()}
        if audit:
            run.refuse_lost_money()
            whole["allocation_audit"] = run.audit
        if run.options.lenient:
            whole["rejected_rows"] = run.rejected
        version = _set(spark, target, catalog).commit(whole, by_month, {run.end})
    except BaseException:
        workspace.failed()
        raise
    workspace.clear()
    return version


def published(spark: SparkSession, target: str, name: str, catalog: bool = False) -> DataFrame:
    """A table of the last published set."""
    return _set(spark, target, catalog).read(name)


def _set(spark: SparkSession, target: str, catalog: bool) -> SnapshotSet | CatalogSnapshots:
    return CatalogSnapshots(spark, target) if catalog else SnapshotSet(spark, target)


def read_inputs(spark: SparkSession, source: str, catalog: bool = False, **more) -> RankingInputs:
    """Inputs from Parquet folders under ``source``, or from tables of the database ``source``."""

    def table(name: str) -> DataFrame:
        return spark.table(f"{source}.{name}") if catalog else spark.read.parquet(f"{source}/{name}")

    return RankingInputs(*[table(name) for name in INPUTS], **more)


def run_key(spark: SparkSession, source: str, *settings) -> str:
    """What the tables of a run over the folder ``source`` depend on."""
    return inputs_key(spark, [f"{source}/{name}" for name in INPUTS], *settings)


def no_funding(spark: SparkSession) -> DataFrame:
    """Stands in for a funding table that does not exist: every branch then has 0."""
    return spark.createDataFrame([], FUNDING)
