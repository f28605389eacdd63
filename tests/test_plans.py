"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
import fixtures as fx
from standings import operators as op
from standings.sources import LEDGER, LOAN_TAPE, Workspace

SF_DIR = "/root/testdata/sf0.01"


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The ledger and the loan tape as files, the way a real run reads them."""
    root = tmp_path_factory.mktemp("stored")
    for name, df in (("gl", fx.ledger(spark, SF_DIR)), ("tape", fx.loan_tape(spark, SF_DIR))):
        df.write.parquet(f"{root}/{name}")
    return {
        "gl": spark.read.schema(LEDGER).parquet(f"{root}/gl"),
        "tape": spark.read.schema(LOAN_TAPE).parquet(f"{root}/tape"),
    }


def test_ledger_is_scanned_once_with_its_dates_pushed_down(stored):
    book = fx.LINES
    totals = op.account_totals(stored["gl"], fx.BEGIN, fx.END)
    company = book.funding_costs + book.funding_income + book.card_income
    text = plan(op.gl_rollup(totals, book.branch_lines, company_lines=company))
    assert len(re.findall(r"\) Scan parquet", text)) == 1
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(transaction_date" in pushed and "LessThan(transaction_date" in pushed


def test_loan_tape_filters_and_columns_reach_the_scan(stored):
    months = op.loan_months(stored["tape"], fx.BEGIN, fx.END)
    text = plan(op.cumulative_by_period(
        months.where("written_off"), ["branch_city"], "kpi_month", "write_off_balance_principal",
        op.month_spine(months.sparkSession, fx.BEGIN, fx.END), "total"))
    assert "LessThanOrEqual(kpi_month,200105)" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "psdn" not in schema and "outstanding_principal" not in schema


def test_postings_are_added_up_before_the_shuffle(stored):
    text = plan(op.account_totals(stored["gl"], fx.BEGIN, fx.END))
    assert text.index("partial_sum") < text.index("Exchange", text.index("partial_sum"))
    assert text.count("\n+- Exchange") + text.count("   +- Exchange") <= 1


def test_distributed_rank_has_no_single_partition_over_rows(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_extendedprice")
    specs = [op.RankSpec("l_quantity", "r"), op.RankSpec("l_extendedprice", "s")]
    text = plan(op.rank_distributed(lines, specs), "simple")
    assert "Window" not in text and "SinglePartition" not in text


def test_long_rollup_reads_the_ledger_once(spark, stored):
    totals = op.account_totals(stored["gl"], fx.BEGIN, fx.END)
    long = op.gl_rollup_long(totals, op.line_map_frame(spark, fx.LINES.branch_lines))
    assert len(re.findall(r"\) Scan parquet", plan(long))) == 1


def jobs_of(spark, query, sf_dir=SF_DIR):
    group = f"jobs-{query.__name__}-{id(query)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    finally:
        spark.sparkContext.setJobGroup("none", "none")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("name, most", [("financial_ratios", 40), ("ranking_report", 80)])
def test_jobs_stay_few(spark, name, most):
    """AQE runs every exchange as a job of its own; what is read more than once is staged."""
    assert jobs_of(spark, entry.QUERIES[name]) <= most


def test_workspace_clears_its_own_folder_only(spark, tmp_path):
    work = Workspace(spark, str(tmp_path))
    kept = work.keep(spark.range(3), "numbers")
    assert kept.count() == 3
    (tmp_path / "other").mkdir()
    work.clear()
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
