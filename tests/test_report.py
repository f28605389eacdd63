"""The whole run on hand-made rows with the real account codes."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from standings import Options, RankingInputs, RankingRun, ranking_report
from standings.plans.publish import BY_MONTH, WHOLE, no_funding, publish, published, read_inputs
from standings.operators.ranking import rank_windowed
from standings.plans.report import REPORT, STAFF_RANKS, staff_rank_specs
from standings.sources import FUNDING, LEDGER, LOAN_TAPE, PROVINCES, Workspace, sales_schema
from standings.__main__ import main

MONTH = 202205


def staff(province, name, ltn, month=MONTH):
    return (month, province, name, *[ltn] * 5, *[ltn] * 5, *[10] * 5, *[5] * 5)


def money(rows, at):
    return [tuple(Decimal(v) if i in at and v is not None else v for i, v in enumerate(r)) for r in rows]


def make(spark, sales=None, loans=None, ledger=None, provinces=None, funding=None):
    sales = sales or [staff("North", "n1", 10), staff("North", "n2", 30), staff("Huế", "h1", 20)]
    loans = loans or [
        ("North", 202205, None, 0, 100, 1, 1, 5),
        ("North", 202205, None, 0, 100, 3, 1, 5),
        ("Thừa Thiên Huế", 202205, 202205, 50, 200, 2, 1, 10),
    ]
    ledger = ledger or [
        ("DVS00000001", "851", -100), ("DVS00000002", "851", -50), ("DVS00000000", "851", -30),
        ("DVS00000001", "702000030002", 1000), ("DVS00000002", "702000030002", 400),
        ("DVS00000000", "702000030002", 100),
    ]
    posted = datetime(2022, 3, 15)
    return RankingInputs(
        sales=spark.createDataFrame(money(sales, range(3, 13)), sales_schema()),
        loans=spark.createDataFrame(money(loans, (3, 4, 7)), LOAN_TAPE),
        ledger=spark.createDataFrame(
            [(a, c, Decimal(v), posted) for a, c, v in ledger], LEDGER
        ),
        provinces=spark.createDataFrame(
            provinces or [("00", "Head office"), ("01", "North"), ("02", "Thừa Thiên Huế")], PROVINCES
        ),
        funding=spark.createDataFrame(money(funding or [("North", -10, -5, -5)], (1, 2, 3)), FUNDING),
    )


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_allocation_ratios_and_ranks(spark):
    run = RankingRun(make(spark), workspace=Workspace(spark))
    assert (run.begin, run.end) == (202201, 202205)
    opex = by(run.opex, "branch_city")
    assert opex["North"]["staff_cost"] == -120.0  # -100 and two thirds of -30
    assert opex["Thừa Thiên Huế"]["opex"] == -60.0
    card = by(run.card, "branch_city")
    assert card["North"]["in_term_interest"] == 1100.0  # all group-1 balance is here
    assert card["Thừa Thiên Huế"]["in_term_interest"] == 400.0
    assert card["Head office"]["in_term_interest"] == 100.0
    ratios = by(run.ratios, "branch_city")
    assert set(ratios) == {"North", "Thừa Thiên Huế"}
    assert ratios["North"]["cir"] == round(12000 / 1080, 6)
    assert ratios["North"]["return_on_funding"] == round(-98000 / -20, 6)
    assert ratios["Thừa Thiên Huế"]["return_on_funding"] is None
    branches = by(run.branch_ranks, "branch_city")
    assert branches["Thừa Thiên Huế"]["return_on_funding"] == 0.0
    assert branches["Thừa Thiên Huế"]["rank_return_on_funding"] == 2
    report = by(run.report, "staff_code")
    assert list(run.report.columns) == REPORT
    assert report["h1"]["province"] == "Thừa Thiên Huế"
    assert report["n1"]["npl_before_writeoff"] == 50.0
    assert report["h1"]["npl_before_writeoff"] == 20.0  # (0 + 50) / (200 + 50)
    assert [report[s]["rank_ltn"] for s in ("n2", "h1", "n1")] == [1, 2, 3]


def test_province_without_branch_row_ranks_first(spark):
    sales = [staff("North", "n1", 10), staff("Nowhere", "x1", 5)]
    report = by(ranking_report(make(spark, sales=sales)), "staff_code")
    assert report["x1"]["cir"] is None
    assert (report["x1"]["rank_financial"], report["x1"]["rank_final"]) == (1, 1)
    last = by(ranking_report(make(spark, sales=sales), options=Options(nulls="last")), "staff_code")
    assert (last["x1"]["rank_financial"], last["x1"]["rank_final"], last["x1"]["rank_npl"]) == (2, 2, 2)


def test_opex_is_lost_without_staff_and_kept_on_request(spark):
    inputs = make(spark, sales=[staff("North", "n1", 10)])
    assert by(RankingRun(inputs).opex, "dd")["02"]["opex"] == 0.0
    kept = RankingRun(inputs, options=Options(opex_null_policy="keep_direct"))
    assert by(kept.opex, "dd")["02"]["opex"] == -50.0


def test_no_pool_row(spark):
    ledger = [("DVS00000001", "702000030002", 1000), ("DVS00000001", "851", -100)]
    run = RankingRun(make(spark, ledger=ledger))
    assert run.card.count() == run.other.count() == run.provision.count() == 0
    assert by(run.opex, "dd")["01"]["opex"] == 0.0
    without = RankingRun(make(spark, ledger=ledger), options=Options(require_pool=False))
    assert by(without.card, "branch_city")["North"]["in_term_interest"] == 1000.0


def test_missing_funding_counts_as_zero(spark):
    inputs = replace(make(spark), funding=no_funding(spark))
    ratios = by(RankingRun(inputs).ratios, "branch_city")
    assert ratios["North"]["return_on_funding"] is None and ratios["North"]["cir"] is not None


def test_two_report_months(spark):
    sales = [staff("North", "n1", 10), staff("North", "n1", 99, 202204), staff("North", "n2", 5, 202204)]
    run = RankingRun(make(spark, sales=sales))
    assert run.averages.count() == 3
    assert by(run.headcount, "province")["North"]["heads"] == 1
    every = RankingRun(make(spark, sales=sales), options=Options(all_months_heads=True))
    assert by(every.headcount, "province")["North"]["heads"] == 3
    assert [r["staff_code"] for r in run.report.collect()] == ["n1"]


def test_history_is_ranked_within_its_month(spark):
    inputs = make(spark)
    past = RankingRun(inputs).scorecard.withColumn("month_key", F.lit(202204))
    run = RankingRun(inputs, options=Options(history=past), workspace=Workspace(spark))
    ranks = {(r["month_key"], r["staff_code"]): r["rank_ltn"] for r in run.report.collect()}
    assert len(ranks) == 6
    assert ranks[202204, "n2"] == ranks[202205, "n2"] == 1


def test_report_ranks_equal_plain_windows(spark):
    sales = [staff(p, f"{p}{i}", i % 7) for p in ("North", "Huế", "Nowhere") for i in range(40)]
    run = RankingRun(make(spark, sales=sales), workspace=Workspace(spark))
    plain = rank_windowed(run.scorecard, staff_rank_specs(), ["month_key"])
    names = ["staff_code", *STAFF_RANKS]
    ranks = {tuple(r) for r in plain.select(*names).collect()}
    assert {tuple(r) for r in run.staff_ranks.select(*names).collect()} == ranks
    assert {tuple(r) for r in run.report.select(*names).collect()} == ranks


def test_collation_reaches_every_join(spark):
    sales = [staff("NORTH", "n1", 10)]
    run = RankingRun(make(spark, sales=sales), options=Options(collation="UNICODE_CI_AI"), workspace=Workspace(spark))
    assert by(run.report, "staff_code")["n1"]["cir"] is not None


def allocated_total(direct, pool, kept, drivers):
    return direct + pool * kept / drivers


def test_allocation_keeps_the_money(spark):
    run = RankingRun(make(spark))
    card = sum(r["in_term_interest"] for r in run.card.collect())
    # The pool's own row stays in the result beside the share it handed out.
    assert card == pytest.approx(allocated_total(1500, 100, 100, 100))


def test_publish_is_idempotent_and_keeps_other_months(spark, tmp_path):
    target = str(tmp_path / "out")
    sales = [staff("North", "n1", 10), staff("North", "n1", 99, 202204)]
    for _ in range(2):
        publish(RankingRun(make(spark, sales=sales), workspace=Workspace(spark)), target)
    read = {name: published(spark, target, name) for name in [*WHOLE, *BY_MONTH]}
    assert read["staff_averages"].count() == 2
    assert read["staff_scorecard"].count() == read["ranking_report"].count() == 1
    publish(RankingRun(make(spark, sales=sales), 202204, workspace=Workspace(spark)), target)
    kept = published(spark, target, "staff_scorecard").select("month_key").collect()
    assert sorted(r[0] for r in kept) == [202204, 202205]


def test_publish_ranks_published_history(spark, tmp_path):
    target, inputs = str(tmp_path / "out"), make(spark)
    publish(RankingRun(inputs, workspace=Workspace(spark)), target)
    later = make(spark, sales=[staff("North", "n1", 1, 202206), staff("North", "n2", 2, 202206)])
    history = published(spark, target, "staff_scorecard")
    publish(RankingRun(later, options=Options(history=history), workspace=Workspace(spark)), target)
    report = published(spark, target, "ranking_report")
    assert {r[0] for r in report.select("month_key").collect()} == {202205, 202206}


def test_command_line(spark, tmp_path, monkeypatch):
    inputs, source, target = make(spark), str(tmp_path / "in"), str(tmp_path / "out")
    names = {
        "sales_wide": inputs.sales, "loan_tape": inputs.loans, "gl": inputs.ledger,
        "province_dim": inputs.provinces, "funding_cost_branch": inputs.funding,
    }
    for name, df in names.items():
        df.write.parquet(f"{source}/{name}")
    main([source, target, "--report-month", "202205"])
    assert published(spark, target, "ranking_report").count() == 3
    assert read_inputs(spark, source).sales.count() == 3


def test_staging_needs_a_shared_folder_on_a_cluster():
    from standings.sources.staging import shared_folder

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(Session())


def test_a_failing_run_leaves_published_tables_as_they_were(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    publish(RankingRun(make(spark), workspace=Workspace(spark)), target)
    before = {name: sorted(map(str, published(spark, target, name).collect())) for name in [*WHOLE, *BY_MONTH]}
    run = RankingRun(make(spark, sales=[staff("North", "zz", 1)]), workspace=Workspace(spark))
    broken = run.volume.withColumn("volume", F.raise_error(F.lit("broken")).cast("double"))
    monkeypatch.setattr(run, "volume", broken)
    with pytest.raises(Exception, match="broken"):
        publish(run, target)
    after = {name: sorted(map(str, published(spark, target, name).collect())) for name in [*WHOLE, *BY_MONTH]}
    assert after == before
    assert len(list((tmp_path / "out" / "data").iterdir())) == 1
    from pathlib import Path

    assert not Path(run.workspace.path).exists()


def test_tables_of_a_database(spark):
    spark.sql("create database if not exists published")
    try:
        sales = [staff("North", "n1", 10), staff("North", "n1", 99, 202204)]
        publish(RankingRun(make(spark, sales=sales), 202204, workspace=Workspace(spark)), "published", catalog=True)
        for _ in range(2):
            publish(RankingRun(make(spark, sales=sales), workspace=Workspace(spark)), "published", catalog=True)
        assert spark.table("published.ranking_report").count() == 1
        kept = spark.table("published.staff_scorecard").select("month_key").collect()
        assert sorted(r[0] for r in kept) == [202204, 202205]
        assert spark.table("published.staff_averages").count() == 2
    finally:
        spark.sql("drop database published cascade")


def test_names_are_trimmed(spark):
    sales = [staff(" North ", "n1", 10), staff("North", "n2", 20)]
    run = RankingRun(make(spark, sales=sales), workspace=Workspace(spark))
    rows = by(run.report, "staff_code")
    assert rows["n1"]["cir"] is not None and rows["n1"]["cir"] == rows["n2"]["cir"]
