from decimal import Decimal

import pytest

from standings import operators as op
from standings.functions import month_list
from standings.operators.balances import BALANCES, branch_balances, write_offs
from standings.sources import LOAN_TAPE


def tape(spark, *rows):
    """Rows of (branch, month, write-off month, bucket, channel, outstanding, written off, volume)."""
    cells = [
        (b, m, w, Decimal(wo), Decimal(out), bucket, channel, Decimal(vol))
        for b, m, w, bucket, channel, out, wo, vol in rows
    ]
    return spark.createDataFrame(cells, LOAN_TAPE)


def rows(df):
    return sorted((tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()), key=str)


def test_missing_bucket_counts_as_group_1(spark):
    months = op.loan_months(tape(spark, ("A", 202201, None, None, 1, 100, 0, 0)), 202201, 202205)
    assert rows(branch_balances(months, 202201, 202205)) == [(202201, "A", 100, 0, 100, 0, 0)]


def test_debt_groups_add_up(spark):
    loans = [("A", 202201, None, b, 1, 10**i, 0, 0) for i, b in enumerate([None, 1, 2, 3, 4, 5])]
    months = op.loan_months(tape(spark, *loans), 202201, 202205)
    (_, _, total, b345, b1, b2, b2_5) = rows(branch_balances(months, 202201, 202205))[0]
    assert (total, b345, b1, b2, b2_5) == (111111, 111000, 11, 100, 111100)
    assert b1 + b2_5 == total


@pytest.mark.parametrize("channel", [None, 4, 6])
def test_other_channels_count_for_volume_only(spark, channel):
    loans = tape(spark, ("A", 202201, 202201, 1, channel, 100, 50, 7))
    months = op.loan_months(loans, 202201, 202205)
    assert rows(branch_balances(months, 202201, 202205)) == []
    assert rows(write_offs(months)) == []
    volume = op.grouped_total(months, ["branch_city"], "psdn", "volume", "kpi_month", 202201, 202205)
    assert rows(volume) == [("A", 7)]


def running(spark, loans, begin, end, first=None):
    """The running write-off both ways, which must agree."""
    months = op.loan_months(loans, begin, end)
    args = (write_offs(months), ["branch_city"], "kpi_month", "write_off_balance_principal")
    joined = op.cumulative_by_period(*args, op.month_spine(spark, begin, end), "total", first)
    window = op.cumulative_by_period_window(*args, month_list(begin, end), "total", first)
    assert rows(joined) == rows(window)
    return rows(joined)


def test_early_write_off_is_carried_into_every_month(spark):
    loans = tape(spark, ("A", 202112, 202112, 1, 1, 0, 5, 0))
    assert running(spark, loans, 202201, 202203) == [(m, "A", 5) for m in (202201, 202202, 202203)]
    assert running(spark, loans, 202201, 202203, first=202201) == []


def test_late_write_off_starts_in_its_month(spark):
    loans = tape(
        spark,
        ("A", 202203, 202203, 1, 1, 0, 5, 0),
        ("A", 202205, 202205, 1, 1, 0, 2, 0),
        ("A", 202206, 202206, 1, 1, 0, 9, 0),
    )
    assert running(spark, loans, 202201, 202205) == [
        (202203, "A", 5), (202204, "A", 5), (202205, "A", 7),
    ]


def test_write_off_shown_in_another_month_is_ignored(spark):
    loans = tape(spark, ("A", 202202, 202201, 1, 1, 0, 5, 0), ("A", 202202, None, 1, 1, 0, 5, 0))
    assert running(spark, loans, 202201, 202205) == []


def test_mean_counts_only_months_with_rows(spark):
    loans = tape(spark, ("A", 202201, None, 1, 1, 100, 0, 0), ("A", 202204, None, 1, 1, 300, 0, 0))
    balances = branch_balances(op.loan_months(loans, 202201, 202205), 202201, 202205)
    assert op.period_mean(balances, ["branch_city"], BALANCES).first()["avg_balance"] == 200.0


def test_period_mean_counts_null_rows(spark):
    df = spark.createDataFrame([("A", 10), ("A", None)], "k string, v int")
    assert op.period_mean(df, ["k"], ["v"]).first()["avg_v"] == 5.0


def test_mean_before_write_off_and_npl(spark):
    base = spark.createDataFrame(
        [(1, "A", 100, 20), (2, "A", 200, 40), (2, "B", 0, 0)], "m int, b string, total int, bad int"
    )
    extra = spark.createDataFrame([(2, "A", 50)], "m int, b string, wo int")
    mean = op.adjusted_period_mean(base, extra, ["m", "b"], "wo", ["b"], ["total", "bad"])
    assert rows(mean) == [("A", 175.0, 55.0), ("B", 0.0, 0.0)]
    npl = op.adjusted_share(base.where("m = 2"), extra, ["m", "b"], "wo", "bad", "total", "npl")
    assert rows(npl) == [(2, "A", 36.0), (2, "B", None)]
