"""What is kept between runs: write-offs, sums of inputs, staged tables, published sets."""

import re
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from standings import Options, RankingRun
from standings.__main__ import main
from standings.operators.ledger import account_months, account_totals, totals_of_months
from standings.plans.incremental import with_kept_sums
from standings.plans.publish import publish, published, read_inputs, run_key
from standings.sources import LEDGER, LOAN_TAPE, CatalogSnapshots, ResumableWorkspace, SnapshotSet, Workspace
from standings.sources.files import Manifest
from standings.sources.partials import PartialSums
from test_report import make, staff


def rows(df):
    return sorted(map(str, df.collect()))


def loan(branch, month, off, amount, bucket=1, channel=1):
    return (branch, month, off, amount, 100 + month % 100, bucket, channel, 5)


LOANS = [
    loan("North", 202011, 202011, 7),
    loan("North", 202112, 202112, 11),
    loan("Huế", 202103, 202103, 13),
    loan("Huế", 202112, 202201, 500),
    loan("East", 202112, 202112, None),
    loan("North", 202201, 202201, 17),
    loan("North", 202203, None, 0, 3),
    loan("Huế", 202205, 202205, 19, 2),
    loan("North", 202205, None, 0, None),
    loan("North", 202205, 202205, 23, 1, 4),
    loan("North", 202206, 202206, 29),
]


def stored_inputs(spark, folder, loans=None, posted=("2022-01-10", "2022-03-15", "2022-05-02")):
    """The inputs as folders; ledger and tape partitioned by month, as one keeps them."""
    inputs = make(spark, loans=loans or LOANS)
    inputs.sales.write.parquet(f"{folder}/sales_wide")
    inputs.provinces.write.parquet(f"{folder}/province_dim")
    inputs.funding.write.parquet(f"{folder}/funding_cost_branch")
    ledger = inputs.ledger
    several = [ledger.withColumn("transaction_date", F.lit(day).cast("timestamp_ntz")) for day in posted]
    for day, df in zip(posted, several):
        df.coalesce(1).write.parquet(f"{folder}/gl/posted={day[:7]}")
    inputs.loans.repartition("kpi_month").write.partitionBy("kpi_month").parquet(f"{folder}/loan_tape")
    return read_inputs(spark, folder)


# Carried write-offs ---------------------------------------------------------------------


def test_carried_write_offs_equal_the_whole_tape(spark, tmp_path):
    inputs, target = make(spark, loans=LOANS), str(tmp_path / "out")
    publish(RankingRun(inputs, 202112, 202101, workspace=Workspace(spark)), target)
    state = published(spark, target, "writeoff_state")
    for end in (202201, 202205, 202206):
        whole = RankingRun(inputs, end, workspace=Workspace(spark))
        carried = RankingRun(inputs, end, options=Options(writeoff_state=state), workspace=Workspace(spark))
        assert carried.carried_through == 202112
        for table in ("writeoff", "balances", "mean_balances_before_writeoff", "npl"):
            assert rows(getattr(carried, table)) == rows(getattr(whole, table)), table
    # A later year goes on from the year before, and older states serve as well.
    publish(RankingRun(inputs, 202205, options=Options(writeoff_state=state), workspace=Workspace(spark)), target)
    state = published(spark, target, "writeoff_state")
    assert {r[0] for r in state.select("month_key").collect()} == {202112, 202205}
    later = RankingRun(inputs, 202302, options=Options(writeoff_state=state))
    assert later.carried_through == 202205
    assert rows(later.writeoff) == rows(RankingRun(inputs, 202302).writeoff)


def test_the_tape_scan_has_a_pushed_lower_bound(spark, tmp_path):
    make(spark, loans=LOANS).loans.write.parquet(f"{tmp_path}/tape")
    inputs = replace(make(spark), loans=spark.read.schema(LOAN_TAPE).parquet(f"{tmp_path}/tape"))
    publish(RankingRun(inputs, 202112, 202101, workspace=Workspace(spark)), f"{tmp_path}/out")
    run = RankingRun(inputs, 202205, options=Options(writeoff_state=published(spark, f"{tmp_path}/out", "writeoff_state")))
    plan = run.loan_months._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^]]*)\]", plan).group(1)
    assert "GreaterThan(kpi_month,202112)" in pushed and "LessThanOrEqual(kpi_month,202205)" in pushed


def test_states_of_other_options_are_not_used(spark, tmp_path):
    inputs, target = make(spark, loans=LOANS), str(tmp_path / "out")
    publish(RankingRun(inputs, 202112, 202101, Options(from_begin=True), Workspace(spark)), target)
    state = published(spark, target, "writeoff_state")
    assert RankingRun(inputs, 202205, options=Options(writeoff_state=state)).carried_through is None
    publish(RankingRun(inputs, 202112, 202101, workspace=Workspace(spark)), target)
    state = published(spark, target, "writeoff_state")
    other = Options(writeoff_state=state, excluded_channels=(4,))
    assert RankingRun(inputs, 202205, options=other).carried_through is None
    assert RankingRun(inputs, 202112, 202112, options=Options(writeoff_state=state)).carried_through is None


# Kept sums ------------------------------------------------------------------------------


def sums_of(spark, folder, state):
    kept = PartialSums(spark, f"{folder}/gl", state, LEDGER)
    return kept, kept.refresh(lambda df, keys: account_months(df, keys=keys))


def whole_ledger(spark, folder):
    return account_totals(spark.read.schema(LEDGER).parquet(f"{folder}/gl"), 202201, 202205)


def test_a_restated_month_is_read_alone(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    stored_inputs(spark, folder)
    kept, sums = sums_of(spark, folder, state)
    assert len(kept.files_read) == 3
    assert rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))
    kept, sums = sums_of(spark, folder, state)
    assert kept.files_read == [] and rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))

    restated = [("DVS00000001", "851", Decimal(-1), datetime(2022, 3, 1)), ("DVS00000009", "9", Decimal(4), datetime(2022, 3, 2))]
    spark.createDataFrame(restated, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{folder}/gl/posted=2022-03")
    kept, sums = sums_of(spark, folder, state)
    assert [re.search("posted=[0-9-]*", f).group() for f in kept.files_read] == ["posted=2022-03"]
    assert rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))
    assert rows(totals_of_months(sums, 202203, 202203)) == rows(account_totals(spark.createDataFrame(restated, LEDGER), 202203, 202203))

    spark.createDataFrame(restated, LEDGER).coalesce(1).write.mode("append").parquet(f"{folder}/gl/posted=2022-04")
    Path(f"{folder}/gl/posted=2022-01").rename(tmp_path / "gone")
    kept, sums = sums_of(spark, folder, state)
    assert len(kept.files_read) == 1 and "2022-04" in kept.files_read[0]
    assert rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))


def test_files_of_an_unpartitioned_table_are_units(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    make(spark).ledger.repartition(3).write.parquet(f"{folder}/gl")
    kept, sums = sums_of(spark, folder, state)
    number = len(kept.files_read)
    make(spark).ledger.coalesce(1).write.mode("append").parquet(f"{folder}/gl")
    kept, sums = sums_of(spark, folder, state)
    assert number > 1 and len(kept.files_read) == 1
    assert rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))


def test_an_empty_input_and_units_without_rows(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    empty = spark.createDataFrame([], LEDGER)
    empty.write.parquet(f"{folder}/gl")
    kept, sums = sums_of(spark, folder, state)
    assert sums.count() == 0 and set(sums.columns) == {"month_key", "branch_code", "account_code", "amount"}
    make(spark).ledger.coalesce(1).write.mode("append").parquet(f"{folder}/gl")
    kept, sums = sums_of(spark, folder, state)
    assert rows(totals_of_months(sums, 202201, 202205)) == rows(whole_ledger(spark, folder))


@pytest.mark.parametrize("collation", [None, "UNICODE_CI_AI"])
def test_a_report_from_kept_sums_equals_a_full_one(spark, tmp_path, collation):
    folder, options = str(tmp_path / "in"), Options(collation=collation)
    inputs = stored_inputs(spark, folder)
    for turn in range(2):
        kept = with_kept_sums(spark, inputs, folder, str(tmp_path / "state"), options)
        whole = RankingRun(inputs, 202205, options=options, workspace=Workspace(spark))
        run = RankingRun(kept, 202205, options=options, workspace=Workspace(spark))
        for table in ("writeoff", "balances", "volume", "opex", "card", "funding_pool", "ratios", "npl"):
            assert rows(getattr(run, table)) == rows(getattr(whole, table)), table
        # An old month of the tape is restated: its write-offs reach every later month.
        old = make(spark, loans=[loan("North", 202011, 202011, 1000)]).loans
        old.drop("kpi_month").coalesce(1).write.mode("overwrite").parquet(f"{folder}/loan_tape/kpi_month=202011")
        inputs = read_inputs(spark, folder)


# Published sets -------------------------------------------------------------------------


def broken(df):
    name = df.columns[-1]
    return df.withColumn(name, F.raise_error(F.lit("broken")).cast(df.schema[name].dataType))


@pytest.mark.parametrize("fault", ["a", "b", "c", "m", "n", "commit", "torn"])
def test_a_failure_anywhere_leaves_one_whole_set(spark, tmp_path, monkeypatch, fault):
    tables, names = SnapshotSet(spark, str(tmp_path / "set")), ["a", "b", "c", "m", "n"]
    frame = spark.createDataFrame([(202201, 1), (202202, 2)], "month_key int, v int")
    new = frame.withColumn("v", F.col("v") + 10)

    def load(df, at=None):
        each = {name: broken(df) if name == at else df for name in names}
        return tables.commit({n: each[n] for n in "abc"}, {n: each[n] for n in "mn"}, {202201, 202202})

    load(frame)
    real = Manifest.commit

    def torn(self, seen, content):
        number = real(self, seen, content)
        path = Path(self.folder) / f"{number:010d}.json"
        Path(self.folder, f".{path.name}.crc").unlink(missing_ok=True)
        path.write_text(path.read_text()[:40])
        raise OSError("broken")

    def refused(self, seen, content):
        raise OSError("broken")

    if fault in ("commit", "torn"):
        monkeypatch.setattr(Manifest, "commit", torn if fault == "torn" else refused)
    with pytest.raises(Exception, match="broken"):
        load(new, fault)
    assert all(rows(tables.read(n)) == rows(frame) for n in names)
    assert len(list((tmp_path / "set" / "data").iterdir())) == 1
    monkeypatch.undo()
    load(new)
    assert all(rows(tables.read(n)) == rows(new) for n in names)


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    tables = SnapshotSet(spark, str(tmp_path / "set"))
    frame = spark.createDataFrame([(202201, 1), (202202, 2)], "month_key int, v int")
    first = tables.commit({"a": frame}, {"m": frame}, {202201, 202202})
    opened = tables.read("a"), tables.read("m")
    second = tables.commit({"a": frame.where("v = 2")}, {"m": frame.where("v = 1").withColumn("v", F.lit(9))}, {202201})
    assert (first, second, tables.version()) == (1, 2, 2)
    assert [rows(df) for df in opened] == [rows(frame), rows(frame)] == [rows(tables.read("a", first)), rows(tables.read("m", first))]
    assert sorted(tuple(r) for r in tables.read("m").collect()) == [(202201, 9), (202202, 2)]
    tables.commit({"a": frame.limit(0)}, {"m": frame.limit(0)}, {202202})
    assert tables.read("a").count() == 0 and [tuple(r) for r in tables.read("m").collect()] == [(202201, 9)]
    with pytest.raises(Exception):
        tables.read("a", first).count()  # two versions are kept
    with pytest.raises(KeyError, match="no table x"):
        tables.read("x")


def test_the_slower_of_two_writers_is_refused(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path))
    seen = manifest.read()[0]
    manifest.commit(seen, {"by": "first"})
    with pytest.raises(RuntimeError, match="moved on"):
        manifest.commit(seen, {"by": "second"})
    assert manifest.read() == (1, {"by": "first"})


def test_a_database_shows_one_commit_at_a_time(spark, monkeypatch):
    spark.sql("create database if not exists snapped")
    try:
        tables = CatalogSnapshots(spark, "snapped")
        frame = spark.createDataFrame([(202201, 1), (202202, 2)], "month_key int, v int")
        tables.commit({"a": frame, "b": frame}, {"m": frame}, {202201, 202202})
        real = CatalogSnapshots._write

        def failing(self, name, df, number, column):
            if name == "b":
                raise OSError("broken")
            return real(self, name, df, number, column)

        monkeypatch.setattr(CatalogSnapshots, "_write", failing)
        with pytest.raises(OSError, match="broken"):
            tables.commit({"a": frame.limit(0), "b": frame}, {"m": frame})
        assert rows(tables.read("a")) == rows(tables.read("b")) == rows(tables.read("m")) == rows(frame)
        monkeypatch.undo()
        for turn in range(3):
            changed = frame.withColumn("v", F.lit(10 + turn))
            tables.commit({"a": changed, "b": changed}, {"m": changed.where("month_key = 202202")}, {202202})
        assert rows(tables.read("a")) == rows(tables.read("b")) == rows(changed)
        assert sorted(tuple(r) for r in tables.read("m").collect()) == [(202201, 1), (202202, 12)]
        versions = {r[0] for r in spark.table("snapped.a_rows").select("_version").distinct().collect()}
        assert versions == {3, 4}
        tables.commit({"a": frame}, {"m": frame.limit(0)}, {202201, 202202})
        assert tables.read("m").count() == 0 and rows(tables.read("b")) == rows(changed)
    finally:
        spark.sql("drop database snapped cascade")


# Resumed runs ---------------------------------------------------------------------------


def test_a_killed_run_goes_on_from_what_it_had_staged(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "stage")
    inputs = stored_inputs(spark, folder)
    want = rows(RankingRun(inputs, 202205, workspace=Workspace(spark, root)).report)
    key = run_key(spark, folder, "options")
    first = RankingRun(inputs, 202205, workspace=ResumableWorkspace(spark, key, root))
    assert first.allocated.count() and first.drivers.count()
    killed = Path(first.workspace.path)
    assert {p.name for p in killed.iterdir()} >= {"ledger_lines", "loan_months", "allocated", "drivers"}
    (killed / "averages" / "half").mkdir(parents=True)  # a writer that was killed leaves no _SUCCESS

    # The same inputs again, but the ledger and the tape may not be read.
    refused = replace(inputs, ledger=broken(inputs.ledger), loans=broken(inputs.loans))
    again = RankingRun(refused, 202205, workspace=ResumableWorkspace(spark, run_key(spark, folder, "options"), root))
    assert rows(again.report) == want


def test_keys_follow_files_and_settings(spark, tmp_path):
    folder = str(tmp_path / "in")
    stored_inputs(spark, folder)
    key = run_key(spark, folder, "a")
    assert run_key(spark, folder, "a") == key != run_key(spark, folder, "b")
    make(spark).ledger.limit(1).write.mode("append").parquet(f"{folder}/gl/posted=2022-05")
    assert run_key(spark, folder, "a") != key


def test_command_line_with_state_resume_and_carried_write_offs(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    inputs = stored_inputs(spark, folder)
    main([folder, target, "--report-month", "202112", "--begin-month", "202101", "--carry-writeoff"])
    main([folder, target, "--report-month", "202205", "--carry-writeoff", "--resume"])
    want = rows(RankingRun(inputs, 202205, workspace=Workspace(spark)).report)
    assert rows(published(spark, target, "ranking_report")) == want
    main([folder, str(tmp_path / "kept"), "--report-month", "202205", "--state", str(tmp_path / "state")])
    assert rows(published(spark, str(tmp_path / "kept"), "ranking_report")) == want
    with pytest.raises(SystemExit):
        main(["db", target, "--catalog", "--state", "x"])
