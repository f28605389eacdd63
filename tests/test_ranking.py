import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from standings import operators as op
from standings.operators.ranking import RankSpec, rank_windowed
from standings.sources import Workspace


def brute_force(values, descending=False, nulls_first=True):
    def key(v):
        if v is None:
            return (0 if nulls_first else 2, 0)
        return (1, -v if descending else v)

    keys = [key(v) for v in values]
    return [1 + sum(other < k for other in keys) for k in keys]


def ranks(df, out="r"):
    return [r[out] for r in df.orderBy("id").collect()]


def frame(spark, values, kind="int"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}")


def both(spark, values, spec, kind="int"):
    df = frame(spark, values, kind)
    plain = ranks(rank_windowed(df, [spec]))
    assert ranks(op.rank_distributed(df, [spec])) == plain
    return plain


def test_ties_share_the_smallest_rank(spark):
    assert both(spark, [10, 10, 5], RankSpec("v", "r", descending=True)) == [1, 1, 3]


def test_nulls_rank_first_upwards_and_last_downwards(spark):
    assert both(spark, [None, 1, 2], RankSpec("v", "r")) == [1, 2, 3]
    assert both(spark, [None, 1, 2], RankSpec("v", "r", descending=True)) == [3, 2, 1]
    assert both(spark, [None, 1, 2], RankSpec("v", "r", nulls="last")) == [3, 1, 2]
    assert both(spark, [None, 1, 2], RankSpec("v", "r", descending=True, nulls="first")) == [1, 3, 2]
    assert both(spark, [None, -1, 2], RankSpec("v", "r", null_value=0)) == [2, 1, 3]


def test_negative_values_pushed_to_the_end(spark):
    spec = RankSpec("v", "r", key=lambda v: F.when(v < 0, v + 10000).otherwise(v))
    assert both(spark, [-5, 20, 30], spec) == [3, 1, 2]


def test_all_null_and_empty(spark):
    assert both(spark, [None, None], RankSpec("v", "r")) == [1, 1]
    assert both(spark, [], RankSpec("v", "r")) == []


def test_decimal_values(spark):
    values = [Decimal(v) for v in ("1.10", "0.30", "1.10", "-2.05")] + [None]
    assert both(spark, values, RankSpec("v", "r"), "decimal(38,6)") == [4, 3, 4, 2, 1]


@pytest.mark.parametrize("descending", [False, True])
def test_a_third_of_all_rows_on_one_value(spark, descending):
    rng = random.Random(7)
    values = [42] * 1000 + [None] * 1000 + [rng.randint(0, 2000) for _ in range(1000)]
    rng.shuffle(values)
    spec = RankSpec("v", "r", descending=descending)
    assert both(spark, values, spec) == brute_force(values, descending, not descending)


def test_histogram_is_cut_into_even_ranges(spark):
    """No window task gets more values than its slice, and a hot value is one row of the histogram."""
    from standings.operators.ranking import _melted, _ranks_of_values

    work, kept = Workspace(spark), {}
    keep = work.keep
    work.keep = lambda df, name: kept.setdefault(name, keep(df, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000).selectExpr("id", "if(id % 3 = 0, 500, id) as v", "id % 7 as w")
        specs = [RankSpec("v", "r"), RankSpec("w", "s")]
        melted = _melted(df, specs, [])
        _ranks_of_values(melted, specs, ["_spec", "_v0"], work)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in kept["value_counts"].groupBy("_slice").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 1.5 * sum(sizes) / len(sizes)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-4, 4), st.integers(-(2**40), 2**40)), max_size=40),
    descending=st.booleans(),
)
def test_distributed_equals_brute_force(spark, values, descending):
    spec = RankSpec("v", "r", descending=descending)
    expected = brute_force(values, descending, not descending)
    assert both(spark, values, spec, kind="bigint") == expected


def test_groups_are_ranked_separately(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 2, None]), rng.randint(0, 20), rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, g int, v int, w double")
    specs = [RankSpec("v", "r", descending=True), RankSpec("w", "s")]
    windowed, spread = rank_windowed(df, specs, ["g"]), op.rank_distributed(df, specs, ["g"])
    for out in ("r", "s"):
        assert ranks(windowed, out) == ranks(spread, out)


@pytest.mark.parametrize("values", [["b", "a", "c", "a"], ["9", "10", "100", "2"], ["é", None, "z", ""]])
def test_text_and_other_orderable_types(spark, values):
    up, down = RankSpec("v", "r"), RankSpec("v", "r", descending=True)
    assert both(spark, values, up, "string") == brute_force([None if v is None else sum(x is not None and x.encode() < v.encode() for x in values) for v in values])
    both(spark, values, down, "string")
    both(spark, [True, None, False, True], down, "boolean")
    both(spark, [b"b", b"", b"\xff", b"b"], up, "binary")
    both(spark, [(1, "b"), (1, "a"), (0, "z"), None], down, "struct<x: int, y: string>")


def test_columns_of_many_types_at_once(spark):
    rng = random.Random(11)
    rows = [
        (i, rng.choice(["x", "y", None]), rng.randint(0, 9), rng.choice([None, 1.5, -2.0, float("nan"), float("inf")]), rng.choice("abc"), Decimal(rng.randint(-50, 50)) / 10)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id int, g string, a int, b double, c string, d decimal(12,2)")
    specs = [RankSpec(c, f"r_{c}_{n}_{d}", descending=d, nulls=n) for c in "abcd" for n in ("first", "last") for d in (False, True)]
    plain = rank_windowed(df, specs, ["g"]).orderBy("id").drop("b").collect()
    assert op.rank_distributed(df, specs, ["g"]).orderBy("id").drop("b").collect() == plain


def test_dates_and_nan(spark):
    from datetime import date, datetime

    assert both(spark, [date(2020, 5, 1), None, date(1999, 1, 1)], RankSpec("v", "r"), "date") == [3, 1, 2]
    times = [datetime(2020, 5, 1, 3), datetime(2020, 5, 1, 2), None]
    assert both(spark, times, RankSpec("v", "r", descending=True), "timestamp") == [1, 2, 3]
    assert both(spark, [float("nan"), 1.0, -0.0, 0.0], RankSpec("v", "r"), "double") == [4, 3, 1, 1]


def exchanges_of_rows(df):
    """The exchanges through which whole rows, not counts, go."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return len([x for x in text.split("\n") if " Exchange" in x]), text


@pytest.mark.parametrize("columns", [1, 2, 11])
def test_two_exchanges_whatever_the_number_of_columns(spark, columns):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(3000).select("id", *[F.expr(f"id * {7 + i} % 1000").alias(f"c{i}") for i in range(columns)])
        specs = [RankSpec(f"c{i}", f"r{i}", descending=i % 2 == 0) for i in range(columns)]
        spread = op.rank_distributed(df, specs)
        # One by value, with its partner the table of ranks, and one by row.
        number, text = exchanges_of_rows(spread)
        assert number == 3 and "Window" not in text and "SinglePartition" not in text
        assert spread.orderBy("id").collect() == rank_windowed(df, specs).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_values_reach_no_single_task(spark, monkeypatch):
    from standings.operators import ranking

    monkeypatch.setattr(ranking, "HOT_ROWS", 50)
    monkeypatch.setattr(ranking, "HOT_SHARE", 64)
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id % 5) as few", "if(id % 3 = 0, null, id) as many")
    specs = [RankSpec("few", "r"), RankSpec("many", "s", descending=True)]
    spread, plain = op.rank_distributed(df, specs), rank_windowed(df, specs)
    assert spread.orderBy("id").collect() == plain.orderBy("id").collect()
    melted, keys = ranking._melted(df, specs, []), ["_spec", "_v0"]
    ranks = ranking._ranks_of_values(melted, specs, keys, Workspace(spark))
    assert ranks.where("_hot").count() == 7  # six values of `few`, and the NULLs of `many`
    dealt = ranking._asking(melted, ranks, keys).repartition(8, *keys)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1500


def test_composite_rank_of_missing_parts(spark):
    df = spark.createDataFrame([(0, 1, 4), (1, 2, 2), (2, 3, None)], "id int, a int, b int")
    assert ranks(op.composite_rank(df, {"r": ["a", "b"]})) == [3, 2, 1]
    assert ranks(op.composite_rank(df, {"r": ["a", "b"]}, nulls="last")) == [2, 1, 3]
