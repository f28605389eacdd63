"""Inputs as they come: spellings of a name, values that do not fit, provinces that match nothing."""

import json
import unicodedata
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from standings import Options, RankingRun
from standings.__main__ import main
from standings.plans.publish import publish, published
from standings.plans.report import LostMoney
from standings.sources import LEDGER, Workspace
from standings.sources.names import with_normal_names
from standings.sources.quarantine import fitting_rows, rejected_rows
from test_report import by, make, staff

HUE, APART = "Thừa Thiên Huế", unicodedata.normalize("NFD", "Thừa Thiên Huế")


def rows(df):
    return sorted(map(str, df.collect()))


# Spellings ------------------------------------------------------------------------------


def test_names_reach_one_form(spark):
    names = [HUE, APART, "plain", None, "", "ﬁ", "Å", "Å"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    for form in ("NFC", "NFD", "NFKC"):
        found = [r.name for r in with_normal_names(df, "name", form).orderBy("i").collect()]
        assert found == [None if n is None else unicodedata.normalize(form, n) for n in names]
    with pytest.raises(ValueError, match="NFX"):
        with_normal_names(df, "name", "NFX")
    assert with_normal_names(df.limit(0), "name", "NFC").count() == 0


@pytest.mark.parametrize("collation", [None, "UNICODE_CI_AI"])
def test_decomposed_and_composed_names_join(spark, collation):
    loans = [(APART, 202205, 202205, 50, 200, 2, 1, 10), (HUE, 202205, None, 0, 100, 1, 1, 7), ("North", 202205, None, 0, 100, 1, 1, 5)]
    sales = [staff("North", "n1", 10), staff(APART, "h1", 20), staff(HUE, "h2", 20)]
    mixed = make(spark, sales=sales, loans=loans, funding=[(APART, -10, -5, -5)])
    plain = make(
        spark,
        sales=[staff("North", "n1", 10), staff(HUE, "h1", 20), staff(HUE, "h2", 20)],
        loans=[(HUE, *loans[0][1:]), *loans[1:]],
        funding=[(HUE, -10, -5, -5)],
    )
    want = RankingRun(plain, options=Options(collation=collation), workspace=Workspace(spark))
    run = RankingRun(mixed, options=Options(collation=collation, normal_form="NFC"), workspace=Workspace(spark))
    for table in ("writeoff", "balances", "volume", "headcount", "ratios", "scorecard"):
        assert rows(getattr(run, table)) == rows(getattr(want, table)), table
    if collation is None:
        apart = RankingRun(mixed, workspace=Workspace(spark))
        assert rows(apart.balances) != rows(want.balances)


# Values that do not fit -----------------------------------------------------------------


def test_bad_rows_are_set_aside_with_reasons(spark):
    text = spark.createDataFrame(
        [("DVS00000001", "851", "-100", "2022-03-15 00:00:00"), ("DVS00000001", "851", "n/a", "2022-03-15 00:00:00"),
         ("DVS00000002", "851", "12x", "soon"), (None, None, None, None)],
        "analysis_code string, account_code string, amount string, transaction_date string",
    )
    assert fitting_rows(text, LEDGER).count() == 2
    found = {tuple(r.reasons): json.loads(r.row) for r in rejected_rows(text, LEDGER, "ledger").collect()}
    assert set(found) == {
        ("amount: n/a is no decimal(18,2)",),
        ("amount: 12x is no decimal(18,2)", "transaction_date: soon is no timestamp_ntz"),
    }
    assert found["amount: n/a is no decimal(18,2)",]["account_code"] == "851"
    with pytest.raises(ValueError, match="missing"):
        fitting_rows(text.drop("amount"), LEDGER)
    typed = spark.createDataFrame([], LEDGER)
    assert rejected_rows(typed, LEDGER, "ledger").count() == 0


def test_a_lenient_run_loads_the_rest(spark, tmp_path):
    inputs = make(spark)
    text = inputs.ledger.withColumn("amount", F.col("amount").cast("string"))
    bad = text.limit(1).withColumn("amount", F.lit("a lot"))
    spoiled = replace(inputs, ledger=text.unionByName(bad))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        RankingRun(spoiled, workspace=Workspace(spark)).opex.collect()
    run = RankingRun(spoiled, options=Options(lenient=True), workspace=Workspace(spark))
    assert rows(run.opex) == rows(RankingRun(inputs, workspace=Workspace(spark)).opex)
    publish(run, str(tmp_path / "out"))
    (row,) = published(spark, str(tmp_path / "out"), "rejected_rows").collect()
    assert (row.input, row.reasons) == ("ledger", ["amount: a lot is no decimal(18,2)"])


# Money ----------------------------------------------------------------------------------


def whole(spark, **more):
    """Inputs whose allocations keep all money: every branch has staff and a row."""
    loans = [("North", 202205, None, 0, 100, b, 1, 5) for b in (1, 2, 3)] + [(HUE, 202205, 202205, 50, 200, 2, 1, 10)]
    return make(spark, loans=more.pop("loans", loans), **more)


def test_audit_accounts_for_every_line(spark):
    run = RankingRun(whole(spark), workspace=Workspace(spark))
    audit = by(run.audit, "line")
    assert set(audit) == {line.name for line in run.lines.branch_lines}
    card = audit["in_term_interest"]
    assert (card["direct"], card["pool"], card["allocated"], card["difference"]) == (1500.0, 100.0, 1600.0, 0.0)
    assert audit["staff_cost"]["allocated"] == -180.0 and audit["staff_cost"]["unmatched"] == []
    run.refuse_lost_money()


def test_an_unmatched_province_is_refused_by_name(spark, tmp_path):
    loans = [("North", 202205, None, 0, 100, 1, 1, 5), ("Atlantis", 202205, None, 0, 300, 1, 1, 5)]
    sales = [staff("North", "n1", 10), staff("Huế", "h1", 20), staff("Lemuria", "l1", 5)]
    run = RankingRun(whole(spark, loans=loans, sales=sales), workspace=Workspace(spark))
    audit = by(run.audit, "line")
    assert audit["in_term_interest"]["difference"] == -75.0 and audit["in_term_interest"]["unmatched"] == ["Atlantis"]
    assert audit["staff_cost"]["unmatched"] == ["Lemuria"]
    with pytest.raises(LostMoney, match="in_term_interest: -75.00, no row for Atlantis.*staff_cost: .*Lemuria"):
        publish(run, str(tmp_path / "out"), audit=True)
    with pytest.raises(KeyError):
        published(spark, str(tmp_path / "out"), "ranking_report")


def test_staff_less_branches_lose_their_own_cost_and_are_seen(spark):
    run = RankingRun(whole(spark, sales=[staff("North", "n1", 10)]), workspace=Workspace(spark))
    assert by(run.audit, "line")["staff_cost"]["difference"] == 50.0
    with pytest.raises(LostMoney, match="staff_cost: \\+50.00"):
        run.refuse_lost_money()


def test_flags_of_the_command_line(spark, tmp_path, capsys):
    inputs, source, target = whole(spark), str(tmp_path / "in"), str(tmp_path / "out")
    text = inputs.ledger.withColumn("amount", F.col("amount").cast("string"))
    bad = spark.createDataFrame([("DVS00000001", "851", "?")], "analysis_code string, account_code string, amount string")
    names = {
        "sales_wide": inputs.sales, "loan_tape": inputs.loans, "province_dim": inputs.provinces,
        "funding_cost_branch": inputs.funding, "gl": text.unionByName(bad.withColumn("transaction_date", F.lit("2022-03-15").cast("timestamp_ntz"))),
    }
    for name, df in names.items():
        df.write.parquet(f"{source}/{name}")
    main([source, target, "--lenient", "--audit", "--normal-form", "NFC"])
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1]) == {"rejected": {"ledger": 1}}
    assert published(spark, target, "ranking_report").count() == 3
    audit = by(published(spark, target, "allocation_audit"), "line")
    assert audit["in_term_interest"]["allocated"] == 1600.0
    assert Decimal(str(audit["staff_cost"]["pool"])) == -30
