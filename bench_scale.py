"""Times the core steps on a larger, skewed copy of the inputs.

Usage: ``python bench_scale.py FOLDER [COPIES]``. The copy is made once in FOLDER: every row of
the sf0.1 ledger and loan tape COPIES times, every third of them moved to one branch and one
account, and a staff table of which a third ties on one value and a third has none.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import fixtures as fx
from standings import operators as op
from standings.functions import amount_total, month_list
from standings.operators.balances import branch_balances, write_offs
from standings.operators.ledger import totals_of_months
from standings.operators.ranking import rank_windowed
from standings.sources import LEDGER, LOAN_TAPE
from standings.sources.partials import PartialSums

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def make(spark: SparkSession, folder: str, copies: int) -> None:
    def copied(df):
        return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))

    hot = "copy % 3 = 0"
    ledger = copied(fx.ledger(spark, SF_DIR)).selectExpr(
        f"if({hot}, 'DVS00000001', analysis_code) as analysis_code",
        f"if({hot}, 'Brand#10', account_code) as account_code",
        "amount",
        "timestamp_ntz'2001-01-01' + make_dt_interval(pmod(xxhash64(amount, copy), 150)) as transaction_date",
    )
    ledger.write.parquet(f"{folder}/gl")
    tape = copied(fx.loan_tape(spark, SF_DIR)).withColumn(
        "branch_city", F.expr(f"if({hot}, 'NATION_1', branch_city)")
    )
    tape.drop("copy").write.parquet(f"{folder}/tape")
    staff = spark.range(copies * 250_000).selectExpr(
        "200105 as month_key",
        "id as staff",
        "case id % 3 when 0 then null when 1 then 100.0D else round(rand(7) * 1000, 3) end as skewed",
        "round(rand(11) * 1000000, 2) as spread",
    )
    staff.write.parquet(f"{folder}/staff")


def kept_sums(spark: SparkSession, folder: str, state: str):
    """The ledger's totals from sums kept by file."""
    months = PartialSums(spark, f"{folder}/gl", state, LEDGER).refresh(lambda df, keys: op.account_months(df, keys=keys))
    return totals_of_months(months, fx.BEGIN, fx.END)


def main() -> None:
    folder, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 40
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(f"{folder}/staff/_SUCCESS"):
        make(spark, folder, copies)
    ledger = spark.read.schema(LEDGER).parquet(f"{folder}/gl")
    tape = spark.read.schema(LOAN_TAPE).parquet(f"{folder}/tape")
    staff = spark.read.parquet(f"{folder}/staff")

    lines = fx.LINES.branch_lines
    totals = op.account_totals(ledger, fx.BEGIN, fx.END)
    per_posting = ledger.where("startswith(analysis_code, 'DVS')").selectExpr(
        "substring(analysis_code, 10, 2) as branch_code", "trim(account_code) as account_code", "amount"
    )
    months = op.loan_months(tape, fx.BEGIN, fx.END)
    args = (write_offs(months), ["branch_city"], "kpi_month", "write_off_balance_principal")
    specs = [op.RankSpec("skewed", "a", descending=True), op.RankSpec("spread", "b")]
    four = [*specs, op.RankSpec("skewed", "c"), op.RankSpec("spread", "d", descending=True)]
    state = tempfile.mkdtemp(prefix="state-", dir=folder)
    cases = {
        "ledger_rollup": lambda: op.gl_rollup(totals, lines),
        "ledger_rollup_one_sum_per_line_and_posting": lambda: per_posting.groupBy("branch_code").agg(
            *[
                F.expr(amount_total(f"case when {line.condition()} then amount else 0 end")).alias(line.name)
                for line in lines
            ]
        ),
        "ledger_rollup_one_scan_per_line": lambda: [op.gl_rollup(totals, [line]) for line in lines],
        "loan_months": lambda: months,
        "loan_months_after_carried_write_offs": lambda: op.loan_months(tape, fx.BEGIN, fx.END, after=200012),
        "kept_sums_first_run": lambda: kept_sums(spark, folder, state),
        "kept_sums_unchanged": lambda: kept_sums(spark, folder, state),
        "balances": lambda: branch_balances(months, fx.BEGIN, fx.END),
        "writeoff_range_join": lambda: op.cumulative_by_period(
            *args, op.month_spine(spark, fx.BEGIN, fx.END), "wo"
        ),
        "writeoff_running_sum": lambda: op.cumulative_by_period_window(
            *args, month_list(fx.BEGIN, fx.END), "wo"
        ),
        "rank_distributed": lambda: op.rank_distributed(staff, specs, ["month_key"]),
        "four_ranks_distributed": lambda: op.rank_distributed(staff, four, ["month_key"]),
        "rank_in_one_task": lambda: rank_windowed(staff, specs, ["month_key"]),
    }
    rows = {"ledger": ledger.count(), "tape": tape.count(), "staff": staff.count()}
    seconds = {}
    for name, build in cases.items():
        start = time.perf_counter()
        built = build()
        for df in built if isinstance(built, list) else [built]:
            df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 2)
        print(name, seconds[name], flush=True)
    print(json.dumps({"rows": rows, "seconds": seconds}))


if __name__ == "__main__":
    main()
