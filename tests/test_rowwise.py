import pytest

from standings import operators as op
from standings.functions import month_list, next_month, year_start
from standings.sources import PROVINCES, conform

CELLS = [f"c_{i}" for i in range(1, 6)]


@pytest.mark.parametrize(
    "cells, expected",
    [
        ((10, None, 20, None, None), 15.0),
        ((None,) * 5, None),
        ((0, 10, None, None, None), 5.0),
        ((1, 1, 0, 0, 1), 0.6),
    ],
)
def test_mean_of_present(spark, cells, expected):
    df = spark.createDataFrame([cells], ", ".join(f"{c} int" for c in CELLS))
    assert op.mean_of_present(df, CELLS, "mean").first()["mean"] == expected


@pytest.mark.parametrize(
    "approved, applied, expected",
    [((None, None), (None, None), 0.0), ((1, None), (3, 1), 25.0), ((0, 0), (0, 0), 0.0)],
)
def test_ratio_of_sums(spark, approved, applied, expected):
    df = spark.createDataFrame([approved + applied], "a1 int, a2 int, b1 int, b2 int")
    assert op.ratio_of_sums(df, ["a1", "a2"], ["b1", "b2"], "rate").first()["rate"] == expected


def test_normalize_values_leaves_the_rest(spark):
    df = spark.createDataFrame([("N3", "N3"), ("N33", "x"), (None, "y")], "province string, other string")
    renamed = op.normalize_values(df, "province", {"N3": "NATION_3"})
    assert [tuple(r) for r in renamed.collect()] == [("NATION_3", "N3"), ("N33", "x"), (None, "y")]


def test_conform_matches_by_name_and_reports_missing_columns(spark):
    df = spark.createDataFrame([("x", "North", 1)], "extra string, PROVINCE string, dd int")
    assert conform(df, PROVINCES).first().asDict() == {"dd": "1", "province": "North"}
    with pytest.raises(ValueError, match="province"):
        conform(df.drop("PROVINCE"), PROVINCES)


def test_conform_with_collation_joins_regardless_of_case_and_accent(spark):
    left = conform(spark.createDataFrame([("01", "Huế")], PROVINCES), PROVINCES, "UNICODE_CI_AI")
    right = conform(spark.createDataFrame([("02", "HUE")], PROVINCES), PROVINCES, "UNICODE_CI_AI")
    assert left.join(right, "province").count() == 1


def test_months():
    assert month_list(202111, 202202) == [202111, 202112, 202201, 202202]
    assert next_month(202112) == 202201
    assert year_start(202205) == 202201


def test_report_period_and_spine(spark):
    df = spark.createDataFrame([(202204,), (202205,), (None,)], "month_key int")
    assert tuple(op.report_period(df, "month_key").first()) == (202201, 202205)
    assert tuple(op.report_period(df, "month_key", year=2021).first()) == (202101, 202205)
    months = [r[0] for r in op.month_spine(spark, 202111, 202202).collect()]
    assert months == [202111, 202112, 202201, 202202]
    lazy = op.spine_of_period(op.report_period(df, "month_key"))
    assert [r[0] for r in lazy.collect()] == [202201, 202202, 202203, 202204, 202205]
