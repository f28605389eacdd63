"""Inputs whose sums are kept between runs: a monthly run reads the months that changed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from standings.operators.balances import loan_sums
from standings.operators.ledger import account_months
from standings.plans.report import Options, RankingInputs
from standings.sources.partials import PartialSums
from standings.sources.schemas import LEDGER, LOAN_TAPE, conform


def with_kept_sums(spark: SparkSession, inputs: RankingInputs, source: str, state: str, options: Options) -> RankingInputs:
    """``inputs`` with the ledger and the tape of the folder ``source`` replaced by their kept sums.

    Postings are kept by (month, branch, account), loans by (month, branch, debt group, channel and write-off
    flag), for each partition folder or file of the input. A restated month costs a read of that month; old
    write-offs are rows of the sums, so a restated old month is right at once. Channels and the
    collation are part of what the sums of loans are kept under.
    """
    ledger = PartialSums(spark, f"{source}/gl", f"{state}/gl", LEDGER)
    loans = PartialSums(spark, f"{source}/loan_tape", f"{state}/loan_tape", LOAN_TAPE, options.writeoff_settings())

    def postings(rows, keys):
        return account_months(rows, keys=keys)

    def tape(rows, keys):
        named = conform(rows, LOAN_TAPE, options.collation, keep=keys)
        return loan_sums(named, options.excluded_channels, keys=keys)

    return replace(inputs, account_months=ledger.refresh(postings), loan_sums=loans.refresh(tape))
