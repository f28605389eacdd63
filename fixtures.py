"""The report's input tables, derived from the given tables.

Report month 200105, begin month 200101. The loan tape has one row per order line, the ledger
one posting per order line, the sales sheet one row per customer. See FIXTURES.md for the
shapes; the funding table here comes from the suppliers, so that it grows with the data. At every
size there are branches without funding, one without loans of its own channels (so without a
non-performing share) and one whose revenue is negative (so its cost-income ratio is).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standings.functions import MONEY
from standings.operators.ledger import Line
from standings.plans.report import LineBook

BEGIN, END = 200101, 200105
MONTHS = 5
NO_LOANS, LOSS_MAKER, UNFUNDED_REGION = "NATION_13", 9, 4
ALIASES = {"N3": "NATION_3", "N7": "NATION_7"}


def _brands(*numbers: int) -> tuple[str, ...]:
    return tuple(f"Brand#{n}" for n in numbers)


LINES = LineBook(
    opex=(
        Line("tax_fee", exact=_brands(2)),
        Line("staff_cost", prefixes=_brands(20)),
        Line("management_cost", prefixes=_brands(21)),
        Line("asset_cost", prefixes=_brands(22)),
    ),
    card=(
        Line("in_term_interest", exact=_brands(10, 11, 12)),
        Line("overdue_interest", exact=_brands(13, 14)),
        Line("insurance_fee", exact=_brands(15)),
        Line("limit_fee", exact=_brands(16)),
        Line("late_fee", exact=_brands(17, 18, 19)),
    ),
    other=(
        Line("commission", exact=_brands(23)),
        Line("other_net_cost", exact=_brands(3, 24)),
        Line("business_revenue", exact=_brands(4, 5)),
    ),
    provision=(Line("provision", exact=_brands(24, 3)),),
    funding_costs=(
        Line("cost_deposit_cert", exact=_brands(8)),
        Line("cost_market_1", exact=_brands(9)),
        Line("cost_market_2", exact=_brands(1)),
    ),
    funding_income=(
        Line("funding_revenue", exact=_brands(6, 7)),
        Line("total_income", exact=_brands(*range(10, 20))),
    ),
    card_income=(Line("card_income", exact=_brands(10, 11, 12, 15, 16, 17, 18)),),
)


# Columns of the given tables, so that opening one costs no job.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("dd"), F.col("n_name").alias("province")
    )


def _branch_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))


def loan_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = "year(o_orderdate) * 100 + month(o_orderdate)"
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(_branch_of_customer(spark, sf_dir), F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "n_name as branch_city",
            f"{month} as kpi_month",
            f"""case when l_returnflag = 'R' and l_linenumber % 2 = 0 then {month}
                when l_returnflag = 'R' then year(l_shipdate) * 100 + month(l_shipdate)
                end as write_off_month""",
            f"cast(l_extendedprice as {MONEY}) as outstanding_principal",
            f"cast(cast(l_extendedprice as {MONEY}) - cast(l_quantity as {MONEY}) as {MONEY}) as write_off_balance_principal",
            f"cast(l_quantity as {MONEY}) as psdn",
            "case when l_linenumber <= 5 then l_linenumber end as max_bucket",
            f"case when n_name = '{NO_LOANS}' then 4 else nullif(l_suppkey % 8, 7) end as pos_type_key",
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = ", ".join(f"'{b}'" for b in _brands(1, 3, 8, 9))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            """concat(if(l_linenumber = 7, 'HOC', 'DVS'), '000000',
                if(l_linenumber = 6, '00', lpad(cast(s_nationkey as string), 2, '0')))
                as analysis_code""",
            """concat(if(p_brand = 'Brand#25', 'Z25', p_brand), if(l_linenumber = 1, ' ', ''))
                as account_code""",
            f"""cast(cast(l_extendedprice as {MONEY})
                * if(startswith(p_brand, 'Brand#2') or p_brand in ({costs}), -1, 1)
                * if(s_nationkey = {LOSS_MAKER} and not startswith(p_brand, 'Brand#2'), -1, 1) as {MONEY})
                as amount""",
            "l_shipdate as transaction_date",
        )
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only orders of the five months can fill a cell, so only those are read."""
    orders = table(spark, sf_dir, "orders").where(
        "o_orderdate >= timestamp_ntz'2001-01-01' and o_orderdate < timestamp_ntz'2001-06-01'"
    )
    cells = []
    for m in range(1, MONTHS + 1):
        here = f"month(o_orderdate) = {m}"
        cells += [
            F.expr(f"sum(case when {here} then cast(o_totalprice as {MONEY}) end) as ltn_{m:02d}"),
            F.expr(f"sum(case when {here} then 1 + o_orderkey % 3 end) as psdn_{m:02d}"),
            F.expr(f"sum(case when {here} then 1 end) as appin_{m:02d}"),
            F.expr(f"sum(case when {here} and o_orderstatus = 'F' then 1 end) as approved_{m:02d}"),
        ]
    return (
        _branch_of_customer(spark, sf_dir)
        .join(orders, F.expr("o_custkey = c_custkey"), "left")
        .groupBy("n_name", "c_name")
        .agg(*cells)
        .selectExpr(
            "*",
            f"{END} as month_key",
            "case n_name when 'NATION_3' then 'N3' when 'NATION_7' then 'N7' else n_name end as province",
            "c_name as staff_code",
        )
        .drop("n_name", "c_name")
    )


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers, added up by branch; the branches of one region have no funding of their own."""
    balance = F.col("s_acctbal").cast(MONEY)
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != UNFUNDED_REGION)
    count = F.count(F.lit(1))
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("branch_city"))
        .agg(
            F.sum(balance - 10_000).cast(MONEY).alias("cost_deposit_cert"),
            (count * -500).cast(MONEY).alias("cost_market_1"),
            (count * -100).cast(MONEY).alias("cost_market_2"),
        )
    )


class GivenInputs:
    """`RankingInputs` over the given tables, each input opened when it is first used."""

    lines, aliases = LINES, ALIASES
    account_months = loan_sums = None

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._given = spark, sf_dir

    @cached_property
    def sales(self) -> DataFrame:
        return sales(*self._given)

    @cached_property
    def loans(self) -> DataFrame:
        return loan_tape(*self._given)

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger(*self._given)

    @cached_property
    def provinces(self) -> DataFrame:
        return provinces(*self._given)

    @cached_property
    def funding(self) -> DataFrame:
        return funding(*self._given)
