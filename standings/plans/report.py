"""The monthly report: every table of the job as a DataFrame, built on first use."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from standings.functions import month_list, plus, rounded, year_start
from standings.operators.allocation import ZERO_ALL, allocate_pool, allocation_audit, headcount_share
from standings.operators.balances import (
    BALANCES,
    EXCLUDED_CHANNELS,
    adjusted_period_mean,
    adjusted_share,
    branch_balances,
    carried_write_offs,
    cumulative_by_period_window,
    grouped_total,
    loan_months,
    merged_months,
    period_mean,
    write_offs,
)
from standings.operators.ledger import (
    POOL,
    Line,
    account_totals,
    company_totals,
    gl_rollup,
    pool_row,
    proportional_cost,
    totals_of_months,
)
from standings.operators.period import month_spine, report_period
from standings.operators.ranking import RankSpec, composite_rank, rank_distributed, rank_windowed
from standings.operators.rowwise import mean_of_present, normalize_values, ratio_of_sums
from standings.operators.scoring import attach_metric, ratio_scorecard
from standings.plans import lines as real
from standings.sources.schemas import (
    FUNDING,
    LEDGER,
    LOAN_TAPE,
    PROVINCES,
    conform,
    month_columns,
    sales_schema,
)
from standings.sources.names import normal_name, with_normal_names
from standings.sources.quarantine import fitting_rows, rejected_rows
from standings.sources.staging import Workspace


class LostMoney(ValueError):
    """An allocation handed out more or less than its pool."""


@dataclass(frozen=True)
class LineBook:
    """The ledger lines of the report. The default holds the real account codes."""

    opex: tuple[Line, ...] = real.OPEX
    card: tuple[Line, ...] = real.CARD
    other: tuple[Line, ...] = real.OTHER
    provision: tuple[Line, ...] = real.PROVISION
    funding_costs: tuple[Line, ...] = real.FUNDING_COSTS
    funding_income: tuple[Line, ...] = real.FUNDING_INCOME
    card_income: tuple[Line, ...] = real.CARD_INCOME

    @property
    def branch_lines(self) -> tuple[Line, ...]:
        return self.opex + self.card + self.other + self.provision


@dataclass(frozen=True)
class RankingInputs:
    """Input tables, matched by column name against ``standings.sources.schemas``.

    ``account_months`` and ``loan_sums``, rows of the operators of these names, stand in for the ledger
    and the tape, which are then not read.
    """

    sales: DataFrame
    loans: DataFrame
    ledger: DataFrame
    provinces: DataFrame
    funding: DataFrame
    lines: LineBook = field(default_factory=LineBook)
    aliases: dict[str, str] = field(default_factory=lambda: dict(real.PROVINCE_ALIASES))
    account_months: DataFrame | None = None
    loan_sums: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    """Choices of the monthly job; the defaults give the report as it is defined.

    ``months``            month columns per metric in the sales sheet
    ``from_begin``        count write-offs from the begin month only
    ``all_months_heads``  headcount over every month of the sheet
    ``require_pool``      without a head-office row, allocations are empty (else pool 0)
    ``opex_null_policy``  what a missing headcount does to a branch's own operating cost
    ``cir_offset``        pushes negative cost-income ratios behind the positive ones
    ``nulls``             place of missing metrics in ascending staff ranks
    ``collation``         compare names under this collation
    ``normal_form``       bring names to this Unicode normal form (``"NFC"``) before they are compared
    ``lenient``           leave out rows with values that cannot be cast (`RankingRun.rejected` has them);
                          by default the first such value ends the run
    ``history``           earlier scorecards, ranked within their own month beside this one
    ``writeoff_state``    published write-offs to date: tape months up to the latest that ended before
                          this report's first are not read again. Without it, or where it was written under
                          other options, they are; that is also how it is rebuilt after old months were
                          restated
    """

    months: int = 5
    from_begin: bool = False
    all_months_heads: bool = False
    require_pool: bool = True
    opex_null_policy: str = ZERO_ALL
    cir_offset: float = 10_000
    nulls: str | None = None
    excluded_channels: tuple[int, ...] = EXCLUDED_CHANNELS
    collation: str | None = None
    normal_form: str | None = None
    lenient: bool = False
    history: DataFrame | None = None
    writeoff_state: DataFrame | None = None

    def writeoff_settings(self) -> str:
        """What a write-off to date depends on beside the tape."""
        names = f"{self.collation or 'bytes'}/{self.normal_form or 'as given'}"
        return f"channels={sorted(self.excluded_channels)} names={names} lenient={self.lenient}"


# Output columns of the final report, in order.
REPORT = [
    "month_key", "province", "staff_code",
    "ltn_avg", "rank_ltn", "psdn_avg", "rank_psdn",
    "approval_rate_avg", "rank_approval_rate", "npl_before_writeoff", "rank_npl",
    "rank_business",
    "cir", "rank_cir", "margin", "rank_margin",
    "return_on_funding", "rank_return_on_funding", "profit_per_head", "rank_profit_per_head",
    "rank_financial", "rank_final",
]

STAFF_RANKS = ["rank_ltn", "rank_psdn", "rank_approval_rate", "rank_npl"]
BRANCH_RANKS = ["rank_cir", "rank_margin", "rank_return_on_funding", "rank_profit_per_head"]


def staff_rank_specs(nulls: str | None = None) -> list[RankSpec]:
    return [
        RankSpec("ltn_avg", "rank_ltn", descending=True),
        RankSpec("psdn_avg", "rank_psdn", descending=True),
        RankSpec("approval_rate_avg", "rank_approval_rate", descending=True),
        RankSpec("npl_before_writeoff", "rank_npl", nulls=nulls),
    ]


def branch_rank_specs(cir_offset: float) -> list[RankSpec]:
    def cir_order(cir):
        return F.when(cir < 0, cir + F.lit(float(cir_offset))).otherwise(cir)

    return [
        RankSpec("cir", "rank_cir", key=cir_order),
        RankSpec("margin", "rank_margin", descending=True, null_value=0.0),
        RankSpec("return_on_funding", "rank_return_on_funding", descending=True, null_value=0.0),
        RankSpec("profit_per_head", "rank_profit_per_head", descending=True, null_value=0.0),
    ]


class RankingRun:
    """One month's run. Each attribute is one table; nothing runs before a table is used.

    With a ``workspace``, the loan tape, the ledger and the staff averages are read once and their
    sums staged; what follows works on branch-sized tables and on the scorecard.
    """

    def __init__(
        self,
        inputs: RankingInputs,
        report_month: int | None = None,
        begin_month: int | None = None,
        options: Options | None = None,
        workspace: Workspace | None = None,
    ):
        self.inputs = inputs
        self.options = options or Options()
        self.lines = inputs.lines
        self.workspace = workspace
        if report_month is None:
            report_month = report_period(self.sales, "month_key").first()["end_month"]
        self.end = report_month
        self.begin = begin_month or year_start(report_month)

    def _staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.workspace.staged(name, build) if self.workspace else build()

    def _sheet(self, df: DataFrame) -> DataFrame:
        """A table with some rows for each branch, as one partition.

        What is joined and added up of such tables then needs no exchange, and so no job of its own. They
        have as many rows as the company has branches, accounts lines and months, not as it has data.
        """
        return df.coalesce(1) if self.workspace else df

    def _beside(self, df: DataFrame) -> DataFrame:
        """A sheet to be joined to another: merged where both lie, as a broadcast would be one more job."""
        return df.hint("merge") if self.workspace else df

    # Inputs ------------------------------------------------------------------------------

    def _read(self, df: DataFrame, schema: StructType, name: str | None = None) -> DataFrame:
        """An input in its schema, its column ``name`` ready to be compared."""
        lenient = self.options.lenient
        if lenient:
            df = fitting_rows(df, schema)
        if name and self.options.normal_form:
            df = with_normal_names(conform(df, schema, lenient=lenient), name, self.options.normal_form)
        return conform(df, schema, self.options.collation, lenient=lenient)

    @cached_property
    def rejected(self) -> DataFrame:
        """Rows of the inputs that cannot be cast, with the reasons: (input, reasons, row)."""
        given = self.inputs
        parts = [("sales", given.sales, sales_schema(self.options.months)), ("provinces", given.provinces, PROVINCES), ("funding", given.funding, FUNDING)]
        if given.account_months is None:
            parts.append(("ledger", given.ledger, LEDGER))
        if given.loan_sums is None:
            parts.append(("loans", given.loans, LOAN_TAPE))
        return reduce(DataFrame.unionByName, [rejected_rows(df, schema, name) for name, df, schema in parts])

    @cached_property
    def sales(self) -> DataFrame:
        form, aliases = self.options.normal_form, self.inputs.aliases
        if form:
            aliases = {normal_name(k, form): normal_name(v, form) for k, v in aliases.items()}
        sheet = self._read(self.inputs.sales, sales_schema(self.options.months), "province")
        return normalize_values(sheet, "province", aliases)

    @cached_property
    def provinces(self) -> DataFrame:
        return self._sheet(self._read(self.inputs.provinces, PROVINCES, "province"))

    # Sales sheet -------------------------------------------------------------------------

    @cached_property
    def averages(self) -> DataFrame:
        """Staff averages for every month of the sheet."""
        columns = {m: month_columns(m, self.options.months) for m in ("ltn", "psdn", "appin", "approved")}

        def means():
            df = mean_of_present(self.sales, columns["ltn"], "ltn_avg")
            df = mean_of_present(df, columns["psdn"], "psdn_avg")
            df = ratio_of_sums(df, columns["approved"], columns["appin"], "approval_rate_avg")
            return df.select("month_key", "province", "staff_code", "ltn_avg", "psdn_avg", "approval_rate_avg")

        return self._staged("averages", means)

    @cached_property
    def headcount(self) -> DataFrame:

        def heads():
            staff = self.averages
            if not self.options.all_months_heads:
                staff = staff.where(F.col("month_key") == self.end)
            return headcount_share(staff, total=False)

        return self._sheet(self._staged("headcount", heads))

    # Loan tape ---------------------------------------------------------------------------

    @property
    def spine_begin(self) -> int:
        return min(self.begin, year_start(self.end))

    @cached_property
    def spine(self) -> DataFrame:
        """The months of the report year up to the report month."""
        return month_spine(self.inputs.loans.sparkSession, self.spine_begin, self.end)

    @cached_property
    def loan_months(self) -> DataFrame:
        """The loan tape, read once, from the month after the carried write-offs on."""

        def months():
            parts = self.inputs.loan_sums
            if parts is None:
                tape = self._read(self.inputs.loans, LOAN_TAPE)
                parts = loan_months(tape, self.begin, self.end, self.options.excluded_channels, self.carried_through)
                if not self.options.normal_form:
                    return parts
            if self.options.normal_form:
                # Added up first, so that there are few names, and once more under the names' normal form.
                bare = parts.withColumn("branch_city", F.col("branch_city").cast("string"))
                parts = with_normal_names(bare, "branch_city", self.options.normal_form)
                if self.options.collation:
                    parts = parts.withColumn("branch_city", F.collate("branch_city", self.options.collation))
            return merged_months(parts, self.begin, self.end)

        return self._sheet(self._staged("loan_months", months))

    @cached_property
    def _writeoff_state(self) -> DataFrame | None:
        """The published write-offs to date that were added up as this run would."""
        state = self.options.writeoff_state
        if state is None or self.options.from_begin or self.inputs.loan_sums is not None:
            return None
        same = state.where(F.col("settings") == self.options.writeoff_settings())
        name = F.col("branch_city")
        if self.options.collation:
            name = F.collate(name, self.options.collation)
        return same.select("month_key", name.alias("branch_city"), "writeoff_to_date")

    @cached_property
    def carried_through(self) -> int | None:
        """The last month before the spine whose write-offs to date are known."""
        if self._writeoff_state is None:
            return None
        before = self._writeoff_state.where(F.col("month_key") < self.spine_begin)
        return before.agg(F.max("month_key")).first()[0]

    @cached_property
    def writeoff(self) -> DataFrame:
        begin = self.begin if self.options.from_begin else None
        months = month_list(self.spine_begin, self.end)
        moved = write_offs(self.loan_months)
        if self.carried_through is not None:
            moved = carried_write_offs(moved, self._writeoff_state, self.carried_through)
        return cumulative_by_period_window(
            moved,
            ["branch_city"],
            "kpi_month",
            "write_off_balance_principal",
            months,
            "writeoff_to_date",
            begin,
        )

    @cached_property
    def carried_writeoff(self) -> DataFrame:
        """The write-offs to date of the report month, for later runs to go on from."""
        settings = "partial" if self.options.from_begin else self.options.writeoff_settings()
        return self.writeoff.where(F.col("month_key") == self.end).withColumn("settings", F.lit(settings))

    @cached_property
    def balances(self) -> DataFrame:
        return branch_balances(self.loan_months, self.begin, self.end)

    @cached_property
    def mean_balances(self) -> DataFrame:
        """Mean monthly balances of each branch, after write-off."""
        means = period_mean(self.balances, ["branch_city"], BALANCES)
        return self._month(means)

    @cached_property
    def mean_balances_before_writeoff(self) -> DataFrame:
        """Mean monthly balances with the write-off to date added back."""
        means = adjusted_period_mean(
            self.balances,
            self._beside(self.writeoff),
            ["month_key", "branch_city"],
            "writeoff_to_date",
            ["branch_city"],
            BALANCES,
        )
        return self._month(means)

    @cached_property
    def volume(self) -> DataFrame:
        total = grouped_total(
            self.loan_months, ["branch_city"], "psdn", "volume", "kpi_month", self.begin, self.end
        )
        return self._month(total)

    @cached_property
    def drivers(self) -> DataFrame:
        """What the pools are spread by: one row per branch, from the three tables above."""

        def merged():
            before = self.mean_balances_before_writeoff.selectExpr(
                "branch_city", "avg_balance_2_5 as avg_balance_2_5_before_writeoff"
            )
            rows = self.mean_balances.drop("month_key").unionByName(before, allowMissingColumns=True)
            rows = rows.unionByName(self.volume.drop("month_key"), allowMissingColumns=True)
            names = [c for c in rows.columns if c != "branch_city"]
            return rows.groupBy("branch_city").agg(*[F.max(c).alias(c) for c in names])

        return self._sheet(self._staged("drivers", merged))

    @cached_property
    def npl(self) -> DataFrame:
        """Non-performing share of the report month, write-offs added back."""
        return adjusted_share(
            self.balances.where(F.col("month_key") == self.end),
            self._beside(self.writeoff),
            ["month_key", "branch_city"],
            "writeoff_to_date",
            "balance_3_5",
            "balance",
            "npl_before_writeoff",
        )

    def _month(self, df: DataFrame) -> DataFrame:
        return df.select(F.lit(self.end).alias("month_key"), *df.columns)

    # Staff scorecard ---------------------------------------------------------------------

    @cached_property
    def scorecard(self) -> DataFrame:
        staff = self.averages.where(F.col("month_key") == self.end)
        npl = self.npl.withColumnRenamed("branch_city", "province")
        return attach_metric(staff, npl, ["month_key", "province"])

    # Ledger ------------------------------------------------------------------------------

    @cached_property
    def ledger_lines(self) -> DataFrame:
        """The ledger, read once: every line by branch code, the pool and the rest among them."""
        lines = self.lines
        company = lines.funding_costs + lines.funding_income + lines.card_income

        def rollup():
            if self.inputs.account_months is not None:
                totals = totals_of_months(self.inputs.account_months, self.begin, self.end)
            else:
                totals = account_totals(self._read(self.inputs.ledger, LEDGER), self.begin, self.end)
            return gl_rollup(totals, lines.branch_lines, company_lines=company)

        return self._sheet(self._staged("ledger_lines", rollup))

    @cached_property
    def pool(self) -> Column:
        """The head-office amounts of all lines."""
        names = [line.name for line in self.lines.branch_lines]
        return pool_row(self.ledger_lines.select("branch_code", *names))

    def _slice(self, lines) -> DataFrame:
        by_code = self.ledger_lines.where(F.col("branch_code").isNotNull())
        return by_code.select("branch_code", *[line.name for line in lines])

    @cached_property
    def opex_direct(self) -> DataFrame:
        return self._slice(self.lines.opex).where(F.col("branch_code") != POOL)

    @cached_property
    def opex_pool(self) -> DataFrame:
        return self._slice(self.lines.opex).where(F.col("branch_code") == POOL)

    @cached_property
    def card_direct(self) -> DataFrame:
        return self._slice(self.lines.card)

    @cached_property
    def other_direct(self) -> DataFrame:
        return self._slice(self.lines.other)

    @cached_property
    def provision_direct(self) -> DataFrame:
        return self._slice(self.lines.provision)

    @cached_property
    def funding_pool(self) -> DataFrame:
        """Funding cost of the whole company, the card business's share of it."""
        company = company_totals(
            self.ledger_lines, self.lines.funding_costs + self.lines.funding_income, self.lines.card_income
        )
        costs = [line.name for line in self.lines.funding_costs]
        return proportional_cost(company, costs, "card_income", ["total_income", "funding_revenue"])

    # Allocation --------------------------------------------------------------------------

    @cached_property
    def opex(self) -> DataFrame:
        """Operating cost per branch, the head-office pool spread by headcount."""
        names = [line.name for line in self.lines.opex]
        shared = allocate_pool(
            self._opex_direct_rows,
            self.pool,
            self._beside(self.headcount),
            "province",
            dict.fromkeys(names, "heads"),
            null_policy=self.options.opex_null_policy,
            require_pool=False,
        )
        return shared.select(
            "dd",
            F.col("province").alias("branch_city"),
            *names,
            F.expr(rounded(plus(names))).alias("opex"),
        )

    @property
    def _spread_by(self) -> dict[str, str]:
        return {
            "in_term_interest": "avg_balance_1",
            "overdue_interest": "avg_balance_2",
            "insurance_fee": "volume",
            "limit_fee": "avg_balance_1",
            "late_fee": "avg_balance_2_5",
            **{line.name: "avg_balance" for line in self.lines.other},
            "provision": "avg_balance_2_5_before_writeoff",
        }

    @cached_property
    def _allocated_direct(self) -> DataFrame:
        names = self.provinces.selectExpr("dd as branch_code", "province as branch_city")
        direct = self._slice(self.lines.card + self.lines.other + self.lines.provision)
        return direct.join(self._beside(names), "branch_code", "left")

    @cached_property
    def _opex_direct_rows(self) -> DataFrame:
        names = [line.name for line in self.lines.opex]
        branches = self.provinces.where(F.col("dd") != POOL)
        base = branches.join(self._beside(self.opex_direct), F.col("dd") == F.col("branch_code"), "left")
        return base.select("dd", "province", *names)

    @cached_property
    def audit(self) -> DataFrame:
        """What became of the money of every line, from tables that are staged already."""
        shared, opex = self._spread_by, {line.name: "heads" for line in self.lines.opex}
        pool = self.ledger_lines.where(F.col("branch_code") == POOL)
        direct = self._allocated_direct
        if self.options.require_pool:
            direct = direct.where(self.pool.isNotNull())
        return allocation_audit(direct, pool, self.drivers, self.allocated, "branch_city", shared).unionByName(
            allocation_audit(self._opex_direct_rows, pool, self.headcount, self.opex.withColumnRenamed("branch_city", "province"), "province", opex)
        )

    def refuse_lost_money(self, tolerance: float = 0.005) -> None:
        """Raise `LostMoney`, naming lines and unmatched branches, if an allocation does not keep its money."""
        lost = [r for r in self.audit.orderBy("line").collect() if abs(r["difference"]) > tolerance]
        if lost:
            told = [f"{r['line']}: {r['difference']:+.2f}" + (f", no row for {', '.join(r['unmatched'])}" if r["unmatched"] else "") for r in lost]
            raise LostMoney("; ".join(told))

    @cached_property
    def allocated(self) -> DataFrame:
        """Card revenue, other cost and provisions per branch code, pools spread over branches.

        Interest and late fees follow the balances they are earned on, insurance the volume,
        other cost the whole balance, provisions the groups 2-5 before write-off.
        """

        def shared():
            return allocate_pool(
                self._allocated_direct,
                self.pool,
                self._beside(self.drivers),
                "branch_city",
                self._spread_by,
                require_pool=self.options.require_pool,
            )

        return self._sheet(self._staged("allocated", shared))

    @cached_property
    def card(self) -> DataFrame:
        """Card revenue per branch, the pool's own row included."""
        return self.allocated.select("branch_city", *[line.name for line in self.lines.card])

    @cached_property
    def other(self) -> DataFrame:
        """Commission, other net cost and business revenue per branch, the pool's row included."""
        return self.allocated.select("branch_city", *[line.name for line in self.lines.other])

    @cached_property
    def provision(self) -> DataFrame:
        """Provision cost per branch, without the pool's row."""
        branches = self.allocated.where(F.col("branch_code") != POOL)
        return branches.select("branch_city", *[line.name for line in self.lines.provision])

    # Ratios and ranks --------------------------------------------------------------------

    @cached_property
    def ratios(self) -> DataFrame:
        """The four financial ratios of every branch but the head office."""

        def by_province(df, **columns):
            return df.selectExpr(
                "branch_city as province", *[f"{rounded(v)} as {name}" for name, v in columns.items()]
            )

        card = plus([line.name for line in self.lines.card])
        other = plus([line.name for line in self.lines.other])
        fund = "cast(" + plus([f.name for f in FUNDING if f.name != "branch_city"]) + " as double)"
        funding = self._sheet(self._read(self.inputs.funding, FUNDING, "branch_city"))
        scored = ratio_scorecard(
            self.provinces.where(F.col("dd") != POOL),
            [
                (self._beside(frame), key)
                for frame, key in (
                    (self.opex.select("dd", "opex"), "dd"),
                    (by_province(self.card, card=card), "province"),
                    (by_province(funding, fund=fund), "province"),
                    (by_province(self.other, other=other, other_revenue="business_revenue"), "province"),
                    (by_province(self.provision, provision="provision"), "province"),
                    (self.headcount, "province"),
                )
            ],
        )
        return scored

    @cached_property
    def branch_ranks(self) -> DataFrame:
        """Branches with a cost-income ratio, ranked on the four ratios.

        One window over all branches: there are as many as the company has, not as it has data.
        """
        ranked = rank_windowed(
            self.ratios.where(F.col("cir").isNotNull()), branch_rank_specs(self.options.cir_offset)
        )
        return ranked.select(
            "branch_city",
            "cir",
            *[
                F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                for c in ("margin", "return_on_funding", "profit_per_head")
            ],
            *BRANCH_RANKS,
        )

    @cached_property
    def staff_ranks(self) -> DataFrame:
        """Staff of the report month, and of any history given, ranked within their month."""

        def scored():
            rows = self.scorecard
            if self.options.history is not None:
                past = self.options.history.where(F.col("month_key") != self.end)
                rows = rows.unionByName(past.select(*rows.columns))
            return rows

        return rank_distributed(
            self._staged("scored", scored), staff_rank_specs(self.options.nulls), ["month_key"], self.workspace
        )

    @cached_property
    def report(self) -> DataFrame:
        """The final report: staff and branch ranks side by side and the ranks of their sums."""

        def joined():
            branches = self.branch_ranks.withColumnRenamed("branch_city", "province")
            return self.staff_ranks.join(branches, "province", "left")

        ranked = composite_rank(
            self._staged("joined", joined),
            {
                "rank_business": STAFF_RANKS,
                "rank_financial": BRANCH_RANKS,
                "rank_final": STAFF_RANKS + BRANCH_RANKS,
            },
            ["month_key"],
            self.workspace,
            self.options.nulls,
        )
        return ranked.select(*REPORT)


def ranking_report(
    inputs: RankingInputs,
    report_month: int | None = None,
    begin_month: int | None = None,
    options: Options | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The final report for one month; the latest month of the sales sheet by default."""
    workspace = workspace or Workspace(inputs.sales.sparkSession)
    return RankingRun(inputs, report_month, begin_month, options, workspace).report
