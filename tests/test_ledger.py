from datetime import datetime
from decimal import Decimal

import pytest

from standings import operators as op
from standings.functions import quoted
from standings.operators.allocation import KEEP_DIRECT, ZERO_ALL
from standings.operators.ledger import Line, company_totals
from standings.plans import lines as real
from standings.plans.report import LineBook
from standings.sources import LEDGER


def ledger(spark, *rows):
    """Rows of (analysis code, account code, amount, posting date)."""
    return spark.createDataFrame(
        [(a, c, Decimal(v), datetime.fromisoformat(d)) for a, c, v, d in rows], LEDGER
    )


def code(branch, scope="DVS"):
    return f"{scope}000000{branch}"


def by_code(df):
    return {r["branch_code"]: {k: float(v) for k, v in r.asDict().items() if k != "branch_code"} for r in df.collect()}


def rollup(spark, lines, *rows, **kw):
    return by_code(op.gl_rollup(op.account_totals(ledger(spark, *rows), 202201, 202205), lines, **kw))


def test_exact_codes_are_trimmed_and_prefixes_match(spark):
    found = rollup(
        spark,
        real.OPEX,
        (code("01"), " 831000000001 ", 10, "2022-02-01"),
        (code("01"), "8310000000010", 99, "2022-02-01"),
        (code("01"), "851", 1, "2022-02-01"),
        (code("01"), "8", 99, "2022-02-01"),
        (code("01"), "Z85", 99, "2022-02-01"),
    )
    assert found == {"01": {"tax_fee": 10, "staff_cost": 1, "management_cost": 0, "asset_cost": 0}}


def test_period_runs_to_the_last_moment_of_the_report_month(spark):
    dates = ["2021-12-31T23:59:59", "2022-01-01T00:00:00", "2022-05-31T23:59:59", "2022-06-01T00:00:00"]
    found = rollup(spark, real.PROVISION, *[(code("01"), "790000050101", 1, d) for d in dates])
    assert found["01"]["provision"] == 2


def test_one_account_counts_in_both_of_its_lines(spark):
    lines = real.OTHER + real.PROVISION
    found = rollup(spark, lines, (code("01"), "790000050101", 7, "2022-01-05"))
    assert found["01"]["other_net_cost"] == found["01"]["provision"] == 7


def test_scope_and_pool(spark):
    rows = [
        (code("01"), "851", 1, "2022-01-05"),
        (code("00"), "851", 2, "2022-01-05"),
        (code("01", "HOC"), "851", 4, "2022-01-05"),
        (code("02"), "999", 8, "2022-01-05"),
    ]
    staff = (Line("staff", prefixes=("85",)),)
    assert rollup(spark, staff, *rows) == {"00": {"staff": 2}, "01": {"staff": 1}, "02": {"staff": 0}}
    assert set(rollup(spark, staff, *rows, pool=False)) == {"01", "02"}
    assert set(rollup(spark, staff, *rows, pool=True)) == {"00"}


def test_rollup_by_map_equals_rollup_by_condition(spark):
    lines = LineBook().branch_lines + (Line("twice", exact=("8511",), prefixes=("85", "851")),)
    rows = [(code(f"{b:02d}"), c, b + i, "2022-03-01") for b in range(3) for i, c in enumerate(
        ["8511", "861", "790000050101", "702000030002", "719000030003", "other", ""])]
    totals = op.account_totals(ledger(spark, *rows), 202201, 202205)
    wide = by_code(op.gl_rollup(totals, lines))
    long = {
        (r["branch_code"], r["line"]): float(r["amount"])
        for r in op.gl_rollup_long(totals, op.line_map_frame(spark, lines)).collect()
    }
    assert long == {(b, n): v for b, row in wide.items() for n, v in row.items() if (b, n) in long}
    assert all(v == 0 for b, row in wide.items() for n, v in row.items() if (b, n) not in long)
    assert long["01", "twice"] == 1.0


def test_funding_cost_of_the_whole_company(spark):
    book = LineBook()
    rows = [
        (code("01"), "803000000001", -100, "2022-01-05"),
        (code("01", "HOC"), "802000000002", -40, "2022-01-05"),
        (code("01"), "716000000001", 30, "2022-01-05"),
        (code("01", "HOC"), "716000000001", 20, "2022-01-05"),
        (code("01"), "702000040001", 50, "2022-01-05"),
        (code("01"), "Z16000000001", 999, "2022-01-05"),
    ]
    totals = op.account_totals(ledger(spark, *rows), 202201, 202205)
    company = book.funding_costs + book.funding_income
    rolled = op.gl_rollup(totals, book.branch_lines, company_lines=company + book.card_income)
    row = op.proportional_cost(
        company_totals(rolled, company, book.card_income),
        [line.name for line in book.funding_costs],
        "card_income",
        ["total_income", "funding_revenue"],
    ).first()
    assert row.asDict() == {
        "dd": "00", "cost_deposit_cert": -30.0, "cost_market_1": -12.0, "cost_market_2": 0.0,
    }


def test_excluded_accounts_do_not_count_for_the_company(spark):
    totals = op.account_totals(ledger(spark, (code("01"), "Z1", 5, "2022-01-05")), 202201, 202205)
    every = (Line("every", prefixes=("Z", "1")),)
    assert by_code(op.gl_rollup(totals, (), company_lines=every)) == {"01": {"every": 0}}


def test_line_counts():
    sizes = {line.name: len(line.exact) for line in LineBook().branch_lines + real.FUNDING_COSTS + real.FUNDING_INCOME + real.CARD_INCOME}
    assert sizes == {
        "tax_fee": 5, "staff_cost": 0, "management_cost": 0, "asset_cost": 0,
        "in_term_interest": 3, "overdue_interest": 2, "insurance_fee": 1, "limit_fee": 1, "late_fee": 6,
        "commission": 3, "other_net_cost": 22, "business_revenue": 15, "provision": 12,
        "cost_deposit_cert": 1, "cost_market_1": 4, "cost_market_2": 2,
        "funding_revenue": 32, "total_income": 15, "card_income": 11,
    }


def test_quoted(spark):
    text = "a'b\\c"
    assert spark.sql(f"select {quoted(text)}").first()[0] == text


# Allocation ------------------------------------------------------------------------------


def allocate(spark, policy, direct, pool, drivers, require_pool=True):
    base = spark.createDataFrame([("A", direct)], "b string, cost double")
    pools = spark.createDataFrame([] if pool is None else [(pool,)], "cost double")
    struct = pools.selectExpr("struct(cost)").scalar()
    spread = spark.createDataFrame(drivers, "b string, heads double")
    out = op.allocate_pool(base, struct, spread, "b", {"cost": "heads"}, policy, require_pool)
    return [r["cost"] for r in out.collect()]


@pytest.mark.parametrize(
    "policy, direct, pool, drivers, expected",
    [
        (KEEP_DIRECT, 50.0, 100.0, [("A", 1.0), ("B", 3.0)], [75.0]),
        (ZERO_ALL, 50.0, 100.0, [("A", 1.0), ("B", 3.0)], [75.0]),
        (ZERO_ALL, None, 100.0, [("A", 1.0), ("B", 3.0)], [25.0]),
        (KEEP_DIRECT, 50.0, 100.0, [("B", 3.0)], [50.0]),
        (ZERO_ALL, 50.0, 100.0, [("B", 3.0)], [0.0]),
        (KEEP_DIRECT, 50.0, 100.0, [("A", 0.0)], [50.0]),
        (KEEP_DIRECT, 50.0, 100.0, [], [50.0]),
    ],
)
def test_allocate_pool(spark, policy, direct, pool, drivers, expected):
    assert allocate(spark, policy, direct, pool, drivers) == expected


def test_without_a_pool_row(spark):
    drivers = [("A", 1.0)]
    assert allocate(spark, KEEP_DIRECT, 50.0, None, drivers) == []
    assert allocate(spark, KEEP_DIRECT, 50.0, None, drivers, require_pool=False) == [50.0]
    assert allocate(spark, ZERO_ALL, 50.0, None, drivers, require_pool=False) == [0.0]


def test_headcount_share(spark):
    staff = spark.createDataFrame([("A",), ("A",), (None,)], "province string")
    rows = {r["province"]: (r["heads"], r["total_heads"]) for r in op.headcount_share(staff).collect()}
    assert rows == {"A": (2, 3), None: (1, 3)}
