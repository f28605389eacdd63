"""Every registered query against its SQL, on the same Parquet files."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    return value


def sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def run_oracle(sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def check_plan(df):
    """No crossed tables, and only added-up rows in a single task."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        assert "CartesianProduct" not in line
        if "BroadcastNestedLoopJoin" in line:
            # The only nested loop is the month spine against monthly write-offs.
            assert "month_key" in line and "kpi_month" in line
        if "Exchange SinglePartition" in line and "HashAggregate" not in lines[i + 1]:
            # One window over branches, and one over bucket counts; staff and loans never meet in one task.
            below = "\n".join(lines[i + 1 : i + 4])
            assert "staff_code" not in below and "l_orderkey" not in below
            assert "branch_city" in below and "cir" in below or "place" in below and "rows" in below


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.001"])
@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, name, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    if sf_dir == SF_DIR:
        check_plan(df)
    names, rows = run_oracle(entry.oracle_sql()[name], sf_dir)
    assert sorted(df.columns) == sorted(names)
    ours = sorted_rows([tuple(r) for r in df.collect()], df.columns)
    theirs = sorted_rows(rows, names)
    assert len(ours) == len(theirs)
    assert ours == theirs
    if sf_dir == SF_DIR:
        assert ours


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150


def test_fixtures_reach_every_path(spark):
    """Counts that must not be 0, so that the comparison with SQL covers them."""
    rows = entry.queries()["ranking_report"](spark, SF_DIR).collect()
    ratios = entry.queries()["financial_ratios"](spark, SF_DIR).collect()
    assert any(r.cir is not None and r.cir < 0 for r in ratios)
    assert any(r.npl_before_writeoff is None for r in rows)
    assert any(r.rank_financial is None or r.cir is None for r in rows)
    assert any(r.return_on_funding == 0 or r.return_on_funding is None for r in rows)
    funded = {r[0] for r in entry.fx.funding(spark, SF_DIR).select("branch_city").collect()}
    assert 0 < len(funded) < 25
    averages = entry.queries()["staff_averages"](spark, SF_DIR)
    assert averages.where("psdn_avg <> ltn_avg").count() > 0


@pytest.mark.parametrize("left, right", [("psdn", "appin"), ("outstanding_principal", "write_off_balance_principal")])
def test_swapped_columns_are_seen(spark, left, right):
    """Values that could be mixed up differ."""
    source = entry.fx.sales(spark, SF_DIR) if left == "psdn" else entry.fx.loan_tape(spark, SF_DIR)
    names = [(f"{left}_{m:02d}", f"{right}_{m:02d}") for m in range(1, 6)] if left == "psdn" else [(left, right)]
    for a, b in names:
        assert source.where(f"{a} <> {b}").count() > 0


def test_months_without_rows_are_emptied(spark, tmp_path):
    df = spark.createDataFrame([(1, 202204), (2, 202205)], "v int, month_key int")
    path = str(tmp_path / "t")
    entry.replace_partitions(df, path)
    entry.replace_partitions(df.where("month_key = 0"), path, months=[202205])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, 202204)]
