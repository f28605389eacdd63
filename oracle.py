"""Independent SQL for every registered query, as chains of CTEs over the given tables."""

from __future__ import annotations

BRANDS = {
    "tax_fee": [2],
    "staff_cost": [20],
    "management_cost": [21],
    "asset_cost": [22],
    "in_term_interest": [10, 11, 12],
    "overdue_interest": [13, 14],
    "insurance_fee": [15],
    "limit_fee": [16],
    "late_fee": [17, 18, 19],
    "commission": [23],
    "other_net_cost": [3, 24],
    "business_revenue": [4, 5],
    "provision": [24, 3],
    "funding_revenue": [6, 7],
    "cost_deposit_cert": [8],
    "cost_market_1": [9],
    "cost_market_2": [1],
    "total_income": [10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
    "card_income": [10, 11, 12, 15, 16, 17, 18],
}
PREFIXED = {"staff_cost", "management_cost", "asset_cost"}
OPEX = ["tax_fee", "staff_cost", "management_cost", "asset_cost"]
CARD = ["in_term_interest", "overdue_interest", "insurance_fee", "limit_fee", "late_fee"]
OTHER = ["commission", "other_net_cost", "business_revenue"]
FUNDING = ["cost_deposit_cert", "cost_market_1", "cost_market_2"]
BALANCES = ["balance", "balance_3_5", "balance_1", "balance_2", "balance_2_5"]


def _line(name: str, extra: str = "") -> str:
    if name in PREFIXED:
        test = f"account_code like 'Brand#{BRANDS[name][0]}%'"
    else:
        test = "trim(account_code) in (" + ", ".join(f"'Brand#{n}'" for n in BRANDS[name]) + ")"
    return f"cast(sum(case when {test}{extra} then amount else 0 end) as decimal(38,2)) as {name}"


def _lines(names) -> str:
    return ",\n  ".join(_line(n) for n in names)


def _mean(value: str, out: str) -> str:
    return f"round(cast(sum({value}) as double) / count(*), 6) as {out}"


def _month_cells(m: int) -> str:
    here = f"year(o_orderdate)*100 + month(o_orderdate) = 20010{m}"
    return f"""
  sum(case when {here} then cast(o_totalprice as decimal(18,2)) end) as ltn_0{m},
  sum(case when {here} then 1 + o_orderkey % 3 end) as psdn_0{m},
  sum(case when {here} then 1 end) as appin_0{m},
  sum(case when {here} and o_orderstatus = 'F' then 1 end) as approved_0{m}"""


def _mean_of_present(metric: str) -> str:
    months = [f"{metric}_0{m}" for m in range(1, 6)]
    total = " + ".join(f"coalesce({c}, 0)" for c in months)
    present = " + ".join(f"(case when {c} is null then 0 else 1 end)" for c in months)
    return f"round(cast({total} as double) / nullif({present}, 0), 6) as {metric}_avg"


def _sum_of(metric: str) -> str:
    return "(" + " + ".join(f"coalesce({metric}_0{m}, 0)" for m in range(1, 6)) + ")"


def _share(line: str, driver: str, total: str) -> str:
    """Pool times driver over all drivers, NULL when unknown."""
    return f"cast(p.{line} as double) * cast({driver} as double) / nullif({total}, 0)"


def _total(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(38,6))) as double)"


# name -> (SQL, CTEs it reads)
CTES: dict[str, tuple[str, list[str]]] = {
    "fx_province": (
        "select lpad(cast(n_nationkey as varchar), 2, '0') as dd, n_name as province from nation",
        [],
    ),
    "fx_loan_tape": (
        """select n_name as branch_city,
  year(o_orderdate)*100 + month(o_orderdate) as kpi_month,
  case when l_returnflag = 'R' and l_linenumber % 2 = 0 then year(o_orderdate)*100 + month(o_orderdate)
       when l_returnflag = 'R' then year(l_shipdate)*100 + month(l_shipdate) end as write_off_month,
  cast(l_extendedprice as decimal(18,2)) as outstanding_principal,
  cast(l_extendedprice as decimal(18,2)) - cast(l_quantity as decimal(18,2)) as write_off_balance_principal,
  cast(l_quantity as decimal(18,2)) as psdn,
  case when l_linenumber <= 5 then l_linenumber end as max_bucket,
  case when n_name = 'NATION_13' then 4 else nullif(l_suppkey % 8, 7) end as pos_type_key
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey""",
        [],
    ),
    "fx_gl": (
        """select concat(case when l_linenumber = 7 then 'HOC' else 'DVS' end, '000000',
    case when l_linenumber = 6 then '00' else lpad(cast(s_nationkey as varchar), 2, '0') end)
    as analysis_code,
  concat(case when p_brand = 'Brand#25' then 'Z25' else p_brand end,
    case when l_linenumber = 1 then ' ' else '' end) as account_code,
  cast(cast(l_extendedprice as decimal(18,2))
    * (case when p_brand like 'Brand#2%' or p_brand in ('Brand#1','Brand#3','Brand#8','Brand#9')
       then -1 else 1 end)
    * (case when s_nationkey = 9 and p_brand not like 'Brand#2%' then -1 else 1 end) as decimal(18,2)) as amount,
  l_shipdate as transaction_date
from lineitem
join supplier on l_suppkey = s_suppkey
join part on l_partkey = p_partkey""",
        [],
    ),
    "fx_sales": (
        "select 200105 as month_key,\n"
        "  case n_name when 'NATION_3' then 'N3' when 'NATION_7' then 'N7' else n_name end as province,\n"
        "  c_name as staff_code," + ",".join(_month_cells(m) for m in range(1, 6)) + """
from customer
join nation on c_nationkey = n_nationkey
left join orders on o_custkey = c_custkey
group by n_name, c_name""",
        [],
    ),
    "fx_funding": (
        """select n_name as branch_city,
  cast(sum(cast(s_acctbal as decimal(18,2)) - 10000) as decimal(18,2)) as cost_deposit_cert,
  cast(count(*) * -500 as decimal(18,2)) as cost_market_1,
  cast(count(*) * -100 as decimal(18,2)) as cost_market_2
from supplier join nation on s_nationkey = n_nationkey
where n_regionkey <> 4
group by n_name""",
        [],
    ),
    "sales": (
        """select * replace (case province when 'N3' then 'NATION_3' when 'N7' then 'NATION_7'
  else province end as province) from fx_sales""",
        ["fx_sales"],
    ),
    "averages": (
        f"""select month_key, province, staff_code,
  {_mean_of_present("ltn")},
  {_mean_of_present("psdn")},
  case when {_sum_of("appin")} = 0 then 0.0::double
    else round(cast(100 * {_sum_of("approved")} as double) / {_sum_of("appin")}, 6)
  end as approval_rate_avg
from sales""",
        ["sales"],
    ),
    "spine": (
        """select range as month_key from range(200101, 200106)""",
        [],
    ),
    "writeoff": (
        """select s.month_key, x.branch_city,
  cast(sum(x.amount) as decimal(38,2)) as writeoff_to_date
from (select branch_city, kpi_month, sum(write_off_balance_principal) as amount
      from fx_loan_tape
      where write_off_month is not null and kpi_month = write_off_month and pos_type_key not in (4, 6)
      group by branch_city, kpi_month) x
join spine s on x.kpi_month <= s.month_key
group by s.month_key, x.branch_city""",
        ["fx_loan_tape", "spine"],
    ),
    "balances": (
        """select kpi_month as month_key, branch_city,
  cast(sum(outstanding_principal) as decimal(38,2)) as balance,
  cast(sum(case when max_bucket in (3, 4, 5) then outstanding_principal else 0 end) as decimal(38,2))
    as balance_3_5,
  cast(sum(case when coalesce(max_bucket, 1) = 1 then outstanding_principal else 0 end) as decimal(38,2))
    as balance_1,
  cast(sum(case when coalesce(max_bucket, 1) = 2 then outstanding_principal else 0 end) as decimal(38,2))
    as balance_2,
  cast(sum(case when coalesce(max_bucket, 1) <> 1 then outstanding_principal else 0 end) as decimal(38,2))
    as balance_2_5
from fx_loan_tape
where pos_type_key not in (4, 6) and kpi_month between 200101 and 200105
group by kpi_month, branch_city""",
        ["fx_loan_tape"],
    ),
    "mean_after": (
        "select 200105 as month_key, branch_city,\n  "
        + ",\n  ".join(_mean(c, f"avg_{c}") for c in BALANCES)
        + "\nfrom balances group by branch_city",
        ["balances"],
    ),
    "mean_before": (
        "select 200105 as month_key, x.branch_city,\n  "
        + ",\n  ".join(_mean(f"{c} + coalesce(writeoff_to_date, 0)", f"avg_{c}") for c in BALANCES)
        + """
from balances x
left join writeoff y on x.month_key = y.month_key and x.branch_city = y.branch_city
group by x.branch_city""",
        ["balances", "writeoff"],
    ),
    "volume": (
        """select 200105 as month_key, branch_city, cast(sum(psdn) as decimal(38,2)) as volume
from fx_loan_tape where kpi_month between 200101 and 200105 group by branch_city""",
        ["fx_loan_tape"],
    ),
    "npl": (
        """select x.month_key, x.branch_city,
  round(cast((balance_3_5 + coalesce(writeoff_to_date, 0)) * 100 as double)
    / nullif(cast(balance + coalesce(writeoff_to_date, 0) as double), 0), 6) as npl_before_writeoff
from balances x
left join writeoff y on x.month_key = y.month_key and x.branch_city = y.branch_city
where x.month_key = 200105""",
        ["balances", "writeoff"],
    ),
    "scorecard": (
        """select a.month_key, a.province, a.staff_code, a.ltn_avg, a.psdn_avg, a.approval_rate_avg,
  n.npl_before_writeoff
from averages a
left join npl n on a.month_key = n.month_key and a.province = n.branch_city
where a.month_key = 200105""",
        ["averages", "npl"],
    ),
    "gl": (
        """select *, substring(analysis_code, 10, 2) as branch_code from fx_gl
where transaction_date >= timestamp '2001-01-01' and transaction_date < timestamp '2001-06-01'""",
        ["fx_gl"],
    ),
    "opex_direct": (
        f"""select branch_code,\n  {_lines(OPEX)}
from gl where analysis_code like 'DVS%' and branch_code <> '00' group by branch_code""",
        ["gl"],
    ),
    "opex_pool": (
        f"""select branch_code,\n  {_lines(OPEX)}
from gl where analysis_code like 'DVS%' and branch_code = '00' group by branch_code""",
        ["gl"],
    ),
    "card_direct": (
        f"""select branch_code,\n  {_lines(CARD)}
from gl where analysis_code like 'DVS%' group by branch_code""",
        ["gl"],
    ),
    "other_direct": (
        f"""select branch_code,\n  {_lines(OTHER)}
from gl where analysis_code like 'DVS%' group by branch_code""",
        ["gl"],
    ),
    "provision_direct": (
        f"""select branch_code,\n  {_lines(["provision"])}
from gl where analysis_code like 'DVS%' group by branch_code""",
        ["gl"],
    ),
    "all_lines": (
        f"""select branch_code,\n  {_lines([*OPEX, *CARD, *OTHER, "provision"])}
from gl where analysis_code like 'DVS%' group by branch_code""",
        ["gl"],
    ),
    "company": (
        "select\n  "
        + _lines([*FUNDING, "funding_revenue", "total_income"])
        + ",\n  "
        + _line("card_income", " and analysis_code like 'DVS%'")
        + "\nfrom gl where trim(account_code) not like 'Z%'",
        ["gl"],
    ),
    "heads": (
        """select province, count(*) as heads from averages where month_key = 200105 group by province""",
        ["averages"],
    ),
    "opex": (
        "select dd, branch_city, "
        + ", ".join(OPEX)
        + ", round("
        + " + ".join(OPEX)
        + """, 6) as opex
from (
  select d.dd, d.province as branch_city,
  """
        + ",\n  ".join(
            f"round(coalesce(coalesce(cast(o.{c} as double), 0) + {_share(c, 'h.heads', 't.total')}, 0), 6) as {c}"
            for c in OPEX
        )
        + """
  from fx_province d
  left join opex_direct o on d.dd = o.branch_code
  left join heads h on d.province = h.province
  left join opex_pool p on 1 = 1
  left join (select cast(sum(heads) as double) as total from heads) t on 1 = 1
  where d.dd <> '00'
) a""",
        ["fx_province", "opex_direct", "opex_pool", "heads"],
    ),
    "card": (
        "select d.province as branch_city,\n  "
        + ",\n  ".join(
            f"round(cast(x.{c} as double) + coalesce({_share(c, driver, total)}, 0), 6) as {c}"
            for c, driver, total in [
                ("in_term_interest", "y.avg_balance_1", "z.b1"),
                ("overdue_interest", "y.avg_balance_2", "z.b2"),
                ("insurance_fee", "m.volume", "n.v"),
                ("limit_fee", "y.avg_balance_1", "z.b1"),
                ("late_fee", "y.avg_balance_2_5", "z.b25"),
            ]
        )
        + f"""
from card_direct x
join card_direct p on p.branch_code = '00'
left join fx_province d on x.branch_code = d.dd
left join mean_after y on d.province = y.branch_city
left join (select {_total("avg_balance_1")} as b1, {_total("avg_balance_2")} as b2,
  {_total("avg_balance_2_5")} as b25 from mean_after) z on 1 = 1
left join volume m on d.province = m.branch_city
left join (select {_total("volume")} as v from volume) n on 1 = 1""",
        ["card_direct", "fx_province", "mean_after", "volume"],
    ),
    "other": (
        "select d.province as branch_city,\n  "
        + ",\n  ".join(
            f"round(cast(x.{c} as double) + coalesce({_share(c, 'y.avg_balance', 'z.b')}, 0), 6) as {c}"
            for c in OTHER
        )
        + f"""
from other_direct x
join other_direct p on p.branch_code = '00'
left join fx_province d on x.branch_code = d.dd
left join mean_after y on d.province = y.branch_city
left join (select {_total("avg_balance")} as b from mean_after) z on 1 = 1""",
        ["other_direct", "fx_province", "mean_after"],
    ),
    "provision": (
        f"""select d.province as branch_city,
  round(cast(x.provision as double)
    + coalesce({_share("provision", "y.avg_balance_2_5", "z.b")}, 0), 6) as provision
from provision_direct x
join provision_direct p on p.branch_code = '00'
left join fx_province d on x.branch_code = d.dd
left join mean_before y on d.province = y.branch_city
left join (select {_total("avg_balance_2_5")} as b from mean_before) z on 1 = 1
where x.branch_code <> '00'""",
        ["provision_direct", "fx_province", "mean_before"],
    ),
    "parts": (
        f"""select d.dd, d.province as branch_city,
  coalesce(o.opex, 0) as opex,
  coalesce(c.card, 0) as card,
  coalesce(f.fund, 0) as fund,
  coalesce(k.other, 0) as other,
  coalesce(k.other_revenue, 0) as other_revenue,
  coalesce(v.provision, 0) as provision,
  coalesce(h.heads, 0) as heads
from fx_province d
left join opex o on d.dd = o.dd
left join (select branch_city, round({" + ".join(CARD)}, 6) as card from card) c
  on d.province = c.branch_city
left join (select branch_city, cast({" + ".join(FUNDING)} as double) as fund from fx_funding) f
  on d.province = f.branch_city
left join (select branch_city, round({" + ".join(OTHER)}, 6) as other,
  business_revenue as other_revenue from other) k on d.province = k.branch_city
left join provision v on d.province = v.branch_city
left join heads h on d.province = h.province
where d.dd <> '00'""",
        ["fx_province", "opex", "card", "fx_funding", "other", "provision", "heads"],
    ),
    "ratios": (
        """select dd, branch_city,
  round(opex * -100 / nullif(round(card + fund + other, 6), 0), 6) as cir,
  round(round(card + opex + provision, 6) * 100 / nullif(round(card + other_revenue, 6), 0), 6) as margin,
  round(round(card + opex + provision, 6) * -100 / nullif(fund, 0), 6) as return_on_funding,
  round(round(card + opex + provision, 6) / nullif(heads, 0), 6) as profit_per_head
from parts""",
        ["parts"],
    ),
    "staff_ranks": (
        """select *,
  rank() over (partition by month_key order by ltn_avg desc nulls last) as rank_ltn,
  rank() over (partition by month_key order by psdn_avg desc nulls last) as rank_psdn,
  rank() over (partition by month_key order by approval_rate_avg desc nulls last) as rank_approval_rate,
  rank() over (partition by month_key order by npl_before_writeoff asc nulls first) as rank_npl
from scorecard""",
        ["scorecard"],
    ),
    "branch_ranks": (
        """select branch_city, cir,
  coalesce(margin, 0) as margin,
  coalesce(return_on_funding, 0) as return_on_funding,
  coalesce(profit_per_head, 0) as profit_per_head,
  rank() over (order by case when cir < 0 then cir + 10000 else cir end asc nulls first) as rank_cir,
  rank() over (order by coalesce(margin, 0) desc) as rank_margin,
  rank() over (order by coalesce(return_on_funding, 0) desc) as rank_return_on_funding,
  rank() over (order by coalesce(profit_per_head, 0) desc) as rank_profit_per_head
from ratios where cir is not null""",
        ["ratios"],
    ),
    "report": (
        """select a.month_key, a.province, a.staff_code,
  a.ltn_avg, a.rank_ltn, a.psdn_avg, a.rank_psdn, a.approval_rate_avg, a.rank_approval_rate,
  a.npl_before_writeoff, a.rank_npl,
  rank() over (partition by a.month_key
    order by a.rank_ltn + a.rank_psdn + a.rank_approval_rate + a.rank_npl asc nulls first) as rank_business,
  b.cir, b.rank_cir, b.margin, b.rank_margin, b.return_on_funding, b.rank_return_on_funding,
  b.profit_per_head, b.rank_profit_per_head,
  rank() over (partition by a.month_key
    order by b.rank_cir + b.rank_margin + b.rank_return_on_funding + b.rank_profit_per_head
    asc nulls first) as rank_financial,
  rank() over (partition by a.month_key
    order by a.rank_ltn + a.rank_psdn + a.rank_approval_rate + a.rank_npl
      + b.rank_cir + b.rank_margin + b.rank_return_on_funding + b.rank_profit_per_head
    asc nulls first) as rank_final
from staff_ranks a
left join branch_ranks b on a.province = b.branch_city""",
        ["staff_ranks", "branch_ranks"],
    ),
}


def _needed(names: list[str], found: dict[str, None]) -> dict[str, None]:
    for name in names:
        _needed(CTES[name][1], found)
        found[name] = None
    return found


def chain(reads: list[str], body: str) -> str:
    """``body`` with the CTEs it reads in front."""
    ctes = ",\n".join(f"{name} as (\n{CTES[name][0]}\n)" for name in _needed(reads, {}))
    return f"with {ctes}\n{body}" if ctes else body


def whole(name: str) -> str:
    return chain([name], f"select * from {name}")


def statements() -> dict[str, str]:
    present = ", ".join(
        f"cast({c} as {kind}) as {c}"
        for m in range(1, 6)
        for c, kind in ((f"ltn_0{m}", "decimal(18,2)"),)
    )
    return {
        "alias_normalize": chain(
            ["sales"], "select province, count(*) as staff from sales group by province"
        ),
        "report_period": chain(
            ["fx_loan_tape"],
            """select cast(max(kpi_month) // 100 * 100 + 1 as integer) as begin_month,
  cast(max(kpi_month) as integer) as end_month from fx_loan_tape""",
        ),
        "month_spine": """with recursive bounds as (
  select cast(min(date_trunc('month', o_orderdate)) as date) as first,
    cast(max(date_trunc('month', o_orderdate)) as date) as last from orders
), months as (
  select first as day, last from bounds
  union all
  select cast(day + interval 1 month as date), last from months where day < last
)
select cast(year(day) * 100 + month(day) as integer) as month_key from months""",
        "mean_of_present": chain(
            ["sales"],
            f"select province, staff_code, {present}, {_mean_of_present('ltn')} from sales",
        ),
        "approval_rate": chain(["averages"], "select province, staff_code, approval_rate_avg from averages"),
        "staff_averages": whole("averages"),
        "writeoff_cumulative": chain(
            ["writeoff"],
            "select cast(month_key as integer) as month_key, branch_city, writeoff_to_date from writeoff",
        ),
        "writeoff_cumulative_window": chain(
            ["writeoff"],
            "select cast(month_key as integer) as month_key, branch_city, writeoff_to_date from writeoff",
        ),
        "writeoff_year_to_date": chain(
            ["fx_loan_tape", "spine"],
            """select cast(s.month_key as integer) as month_key, x.branch_city,
  cast(sum(x.write_off_balance_principal) as decimal(38,2)) as writeoff_to_date
from fx_loan_tape x join spine s on x.kpi_month <= s.month_key
where x.kpi_month = x.write_off_month and x.pos_type_key not in (4, 6) and x.kpi_month >= 200101
group by s.month_key, x.branch_city""",
        ),
        "bucket_balances": chain(
            ["balances"], "select * replace (cast(month_key as integer) as month_key) from balances"
        ),
        "period_mean_balances": whole("mean_after"),
        "period_mean_before_writeoff": whole("mean_before"),
        "volume_by_branch": whole("volume"),
        "npl_point_in_time": chain(
            ["npl"], "select * replace (cast(month_key as integer) as month_key) from npl"
        ),
        "staff_scorecard": whole("scorecard"),
        "gl_opex_branch": whole("opex_direct"),
        "gl_opex_pool": whole("opex_pool"),
        "gl_card_revenue": whole("card_direct"),
        "gl_other_cost": whole("other_direct"),
        "gl_provision": whole("provision_direct"),
        "gl_rollup_long": whole("all_lines"),
        "headcount_share": chain(
            ["heads"],
            """select province, heads,
  cast((select sum(heads) from heads) as bigint) as total_heads from heads""",
        ),
        "opex_allocated": whole("opex"),
        "card_revenue_allocated": whole("card"),
        "other_cost_allocated": whole("other"),
        "provision_allocated": whole("provision"),
        "funding_cost_pool": chain(
            ["company"],
            "select '00' as dd,\n  "
            + ",\n  ".join(
                f"round(cast({c} as double) * cast(card_income as double) "
                f"/ nullif(cast(total_income + funding_revenue as double), 0), 6) as {c}"
                for c in FUNDING
            )
            + "\nfrom company",
        ),
        "financial_ratios": whole("ratios"),
        "staff_ranks": whole("staff_ranks"),
        "branch_ranks": whole("branch_ranks"),
        "composite_rank": chain(
            ["staff_ranks"],
            """select month_key, staff_code, rank_ltn, rank_psdn, rank_approval_rate, rank_npl,
  rank() over (partition by month_key
    order by rank_ltn + rank_psdn + rank_approval_rate + rank_npl asc) as rank_business
from staff_ranks""",
        ),
        "rank_distributed": """select l_orderkey, l_linenumber, l_extendedprice, l_quantity,
  rank() over (order by l_extendedprice desc) as rank_price,
  rank() over (order by l_quantity asc) as rank_quantity,
  rank() over (order by case when l_returnflag <> 'N' then l_discount end asc nulls first) as rank_discount
from lineitem""",
        "partition_replace_roundtrip": chain(
            ["balances"],
            """select * replace (cast(month_key as integer) as month_key) from balances
where month_key in (200101, 200104, 200105) or (month_key = 200102 and balance_3_5 > 0)""",
        ),
        "ranking_report": whole("report"),
    }
