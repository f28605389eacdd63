"""General-ledger operators: accounts to lines, company-wide cost shares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.functions import amount_total, first_day, month_of, next_month, plus, quoted, ratio
from standings.sources.schemas import LINE_MAP

# Layout of the analysis code and the code of the head-office pool.
SCOPE = "DVS"
CODE_START, CODE_LENGTH = 10, 2
POOL = "00"


@dataclass(frozen=True)
class Line:
    """A ledger line: the accounts that add up to it, by full code or by first digits."""

    name: str
    exact: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()

    def condition(self) -> str:
        codes = ", ".join(map(quoted, self.exact))
        tests = [f"account_code in ({codes})"] if codes else []
        tests += [f"startswith(account_code, {quoted(p)})" for p in self.prefixes]
        return "(" + " or ".join(tests) + ")"


def account_totals(
    ledger: DataFrame,
    begin: int,
    end: int,
    scope: str = SCOPE,
    code_start: int = CODE_START,
    code_length: int = CODE_LENGTH,
) -> DataFrame:
    """Postings of the period added up by branch code and account: the one ledger scan.

    The period is a half-open date range, which the file scan can use to skip data. The result
    has one row per branch and account, whatever the number of postings, and one decimal sum
    per posting instead of one per line. ``branch_code`` is NULL outside the branch network, that
    is for analysis codes that do not begin with ``scope``.
    """
    posted = F.col("transaction_date")
    code = F.substring("analysis_code", code_start, code_length)
    return (
        ledger.where((posted >= F.lit(first_day(begin))) & (posted < F.lit(first_day(next_month(end)))))
        .select(
            F.when(F.col("analysis_code").startswith(scope), code).alias("branch_code"),
            F.trim("account_code").alias("account_code"),
            "amount",
        )
        .groupBy("branch_code", "account_code")
        .agg(F.expr(amount_total("amount")).alias("amount"))
    )


def account_months(
    ledger: DataFrame,
    scope: str = SCOPE,
    code_start: int = CODE_START,
    code_length: int = CODE_LENGTH,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All postings added up by month, branch code and account: sums that later runs can add to.

    ``keys`` are further columns to keep apart.
    """
    code = F.substring("analysis_code", code_start, code_length)
    return (
        ledger.select(
            *keys,
            month_of(F.col("transaction_date")).alias("month_key"),
            F.when(F.col("analysis_code").startswith(scope), code).alias("branch_code"),
            F.trim("account_code").alias("account_code"),
            "amount",
        )
        .groupBy(*keys, "month_key", "branch_code", "account_code")
        .agg(F.expr(amount_total("amount")).alias("amount"))
    )


def totals_of_months(months: DataFrame, begin: int, end: int) -> DataFrame:
    """`account_totals` of a period from the rows of `account_months`, of any number of parts."""
    return (
        months.where(F.col("month_key").between(begin, end))
        .groupBy("branch_code", "account_code")
        .agg(F.expr(amount_total("amount")).alias("amount"))
    )


def _line_sums(lines, extra: str = "true") -> list[Column]:
    return [
        F.expr(amount_total(f"case when {line.condition()} and {extra} then amount else 0 end")).alias(
            line.name
        )
        for line in lines
    ]


def gl_rollup(
    totals: DataFrame,
    lines,
    pool: bool | None = None,
    company_lines=(),
    exclude_prefix: str = "Z",
    pool_code: str = POOL,
) -> DataFrame:
    """One row per branch code with one column per line; an account may feed several lines.

    ``pool=False`` leaves the head-office code out, ``pool=True`` keeps only that one.
    ``company_lines`` skip the ``exclude_prefix`` accounts and add a row without a code, which
    holds what is posted outside the branch network.
    """
    code = F.col("branch_code")
    scoped = totals if company_lines else totals.where(code.isNotNull())
    if pool is not None:
        scoped = scoped.where(code == pool_code if pool else code != pool_code)
    counted = f"not startswith(account_code, {quoted(exclude_prefix)})"
    return scoped.groupBy("branch_code").agg(*_line_sums(lines), *_line_sums(company_lines, counted))


def company_totals(rollup: DataFrame, lines, network_lines=()) -> DataFrame:
    """One row of line totals for the whole company; ``network_lines`` count branch codes only."""
    in_network = {line.name: f"case when branch_code is not null then {line.name} end" for line in network_lines}
    values = {line.name: line.name for line in lines} | in_network
    return rollup.agg(*[F.expr(amount_total(v)).alias(name) for name, v in values.items()])


def pool_row(rollup: DataFrame, pool_code: str = POOL) -> Column:
    """The head-office row of a rollup as a struct, NULL when there is none."""
    return rollup.where(F.col("branch_code") == pool_code).select(F.struct("*")).scalar()


def proportional_cost(company: DataFrame, pools, num: str, den, pool_code: str = POOL) -> DataFrame:
    """Each pool times ``num`` over the sum of the ``den`` columns, as the pool row."""
    shares = [
        ratio(f"cast({pool} as double) * cast({num} as double)", plus(den)) + f" as {pool}"
        for pool in pools
    ]
    return company.selectExpr(f"{quoted(pool_code)} as dd", *shares)


def line_map_frame(spark: SparkSession, lines) -> DataFrame:
    """Lines as a mapping table ``(line, match_kind, pattern)``."""
    rows = [(line.name, "exact", code) for line in lines for code in line.exact]
    rows += [(line.name, "prefix", code) for line in lines for code in line.prefixes]
    return spark.createDataFrame(rows, LINE_MAP)


def gl_rollup_long(totals: DataFrame, line_map: DataFrame) -> DataFrame:
    """Rollup through a mapping table of any size: one row per branch code and line.

    ``totals`` has one row per branch and account and is read once. Each account offers its full
    code and all its prefixes as candidates, which makes prefix matching an equi-join. An account
    that meets a line twice is counted once.
    """
    length = F.greatest(F.length("account_code"), F.lit(1))
    prefixes = F.transform(
        F.sequence(F.lit(1), length),
        lambda n: F.struct(
            F.lit("prefix").alias("match_kind"), F.substring(F.col("account_code"), 1, n).alias("pattern")
        ),
    )
    whole = F.array(F.struct(F.lit("exact").alias("match_kind"), F.col("account_code").alias("pattern")))
    candidates = totals.where(F.col("branch_code").isNotNull()).select(
        "branch_code", "account_code", "amount", F.inline(F.concat(whole, prefixes))
    )
    met = (
        candidates.join(line_map, ["match_kind", "pattern"])
        .groupBy("branch_code", "line", "account_code")
        .agg(F.max("amount").alias("amount"))
    )
    return met.groupBy("branch_code", "line").agg(F.expr(amount_total("amount")).alias("amount"))
