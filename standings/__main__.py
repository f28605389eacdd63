"""``spark-submit -m standings SOURCE TARGET``: compute and load one month's report."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from standings.operators.allocation import KEEP_DIRECT, ZERO_ALL
from standings.plans.incremental import with_kept_sums
from standings.plans.publish import publish, published, read_inputs, run_key
from standings.plans.report import Options, RankingRun
from standings.sources import ResumableWorkspace, Workspace
from standings.sources.names import FORMS
from standings.sources.snapshots import CatalogSnapshots, SnapshotSet


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="standings", description=__doc__)
    parser.add_argument("source", help="folder of Parquet inputs, or a database with --catalog")
    parser.add_argument("target", help="folder the result tables are loaded into, or a database with --catalog-target")
    parser.add_argument("--catalog", action="store_true", help="SOURCE is a database")
    parser.add_argument("--catalog-target", action="store_true", help="TARGET is a database")
    parser.add_argument("--report-month", type=int, help="YYYYMM; the sheet's latest by default")
    parser.add_argument("--begin-month", type=int, help="YYYYMM; January of the report year by default")
    parser.add_argument("--months", type=int, default=5, help="month columns in the sales sheet")
    parser.add_argument("--from-begin", action="store_true", help="write-offs from the begin month only")
    parser.add_argument("--all-months-heads", action="store_true", help="headcount over every month of the sheet")
    parser.add_argument("--no-pool-needed", action="store_true", help="allocate without a head-office row, pool 0")
    parser.add_argument("--opex-null-policy", choices=[ZERO_ALL, KEEP_DIRECT], default=ZERO_ALL)
    parser.add_argument("--nulls", choices=["first", "last"], help="place of missing metrics in ascending ranks")
    parser.add_argument("--collation", help="compare names under this collation")
    parser.add_argument("--normal-form", choices=FORMS, help="bring names to this Unicode normal form")
    parser.add_argument("--lenient", action="store_true", help="set rows aside that cannot be cast, in the table rejected_rows")
    parser.add_argument("--audit", action="store_true", help="publish nothing when an allocation loses money")
    parser.add_argument("--history", help="earlier scorecards to rank beside the current one: Parquet, a table, or a published folder")
    parser.add_argument("--carry-writeoff", action="store_true", help="go on from the write-offs to date published at TARGET")
    parser.add_argument("--state", help="folder of kept sums: only changed months of ledger and tape are read")
    parser.add_argument("--resume", action="store_true", help="go on from what a failed run of the same inputs has staged")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("standings").getOrCreate()
    history = state = None
    if args.history and args.catalog:
        history = spark.table(args.history)
    elif args.history:
        kept = SnapshotSet(spark, args.history)
        history = kept.read("staff_scorecard") if kept.version() else spark.read.parquet(args.history)
    if args.carry_writeoff:
        earlier = (CatalogSnapshots if args.catalog_target else SnapshotSet)(spark, args.target)
        state = earlier.read("writeoff_state") if earlier.version() else None
    options = Options(
        months=args.months,
        from_begin=args.from_begin,
        all_months_heads=args.all_months_heads,
        require_pool=not args.no_pool_needed,
        opex_null_policy=args.opex_null_policy,
        nulls=args.nulls,
        collation=args.collation,
        normal_form=args.normal_form,
        lenient=args.lenient,
        history=history,
        writeoff_state=state,
    )
    if args.catalog and (args.state or args.resume):
        parser.error("--state and --resume know inputs by their files: SOURCE must be a folder")
    if args.state and args.lenient:
        parser.error("--state reads files in their schema and cannot set rows aside")
    inputs = read_inputs(spark, args.source, args.catalog)
    if args.state:
        inputs = with_kept_sums(spark, inputs, args.source, args.state, options)
    workspace = Workspace(spark)
    if args.resume:
        asked = [(k, v) for k, v in sorted(vars(args).items()) if k not in ("target", "catalog_target", "resume")]
        seen = [SnapshotSet(spark, args.history).version() if args.history else 0, earlier.version() if args.carry_writeoff else 0]
        workspace = ResumableWorkspace(spark, run_key(spark, args.source, asked, seen))
    run = RankingRun(inputs, args.report_month, args.begin_month, options, workspace)
    publish(run, args.target, args.catalog_target, args.audit)
    if args.lenient:
        counts = published(spark, args.target, "rejected_rows", args.catalog_target).groupBy("input").count()
        print(json.dumps({"rejected": {r["input"]: r["count"] for r in counts.collect()}}))


if __name__ == "__main__":
    main()
