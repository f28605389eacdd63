"""Ledger lines of the monthly report: which accounts add up to which cost or revenue line."""

from standings.operators.ledger import Line

# Account codes per line. An account may belong to several lines.
OPEX = (
    Line(
        "tax_fee",
        exact=("831000000001", "831000000002", "832000000101", "832000000001", "831000000102"),
    ),
    Line("staff_cost", prefixes=("85",)),
    Line("management_cost", prefixes=("86",)),
    Line("asset_cost", prefixes=("87",)),
)

CARD = (
    Line("in_term_interest", exact=("702000030002", "702000030001", "702000030102")),
    Line("overdue_interest", exact=("702000030012", "702000030112")),
    Line("insurance_fee", exact=("716000000001",)),
    Line("limit_fee", exact=("719000030002",)),
    Line(
        "late_fee",
        exact=(
            "719000030003", "719000030103", "790000030003",
            "790000030103", "790000030004", "790000030104",
        ),
    ),
)

OTHER = (
    Line("commission", exact=("816000000001", "816000000002", "816000000003")),
    Line(
        "other_net_cost",
        exact=(
            "809000000002", "809000000001", "811000000001", "811000000102", "811000000002",
            "811014000001", "811037000001", "811039000001", "811041000001", "815000000001",
            "819000000002", "819000000003", "819000000001", "790000000003", "790000050101",
            "790000000101", "790037000001", "849000000001", "899000000003", "899000000002",
            "811000000101", "819000060001",
        ),
    ),
    Line(
        "business_revenue",
        exact=(
            "702000010001", "702000010002", "704000000001", "705000000001", "709000000001",
            "714000000002", "714000000003", "714037000001", "714000000004", "714014000001",
            "715000000001", "715037000001", "719000000001", "709000000101", "719000000101",
        ),
    ),
)

PROVISION = (
    Line(
        "provision",
        exact=(
            "790000050001", "882200050001", "790000030001", "882200030001", "790000000001",
            "790000020101", "882200000001", "882200050101", "882200020101", "882200060001",
            "790000050101", "882200030101",
        ),
    ),
)

FUNDING_COSTS = (
    Line("cost_deposit_cert", exact=("803000000001",)),
    Line(
        "cost_market_1",
        exact=("802000000002", "802000000003", "802014000001", "802037000001"),
    ),
    Line("cost_market_2", exact=("801000000001", "802000000001")),
)

FUNDING_INCOME = (
    Line(
        "funding_revenue",
        exact=(
            "702000040001", "702000040002", "703000000001", "703000000002", "703000000003",
            "703000000004", "721000000041", "721000000037", "721000000039", "721000000013",
            "721000000014", "721000000036", "723000000014", "723000000037", "821000000014",
            "821000000037", "821000000039", "821000000041", "821000000013", "821000000036",
            "823000000014", "823000000037", "741031000001", "741031000002", "841000000001",
            "841000000005", "841000000004", "701000000001", "701000000002", "701037000001",
            "701037000002", "701000000101",
        ),
    ),
    Line(
        "total_income",
        exact=(
            "702000030002", "702000030001", "702000030102", "702000030012", "702000030112",
            "716000000001", "719000030002", "719000030003", "719000030103", "790000030003",
            "790000030103", "790000030004", "790000030104", "719000030004", "719000030104",
        ),
    ),
)

# Counted on postings of the branch network only.
CARD_INCOME = (
    Line(
        "card_income",
        exact=(
            "702000030002", "702000030001", "702000030102", "716000000001", "719000030002",
            "719000030003", "719000030103", "719000030004", "719000030104", "790000030004",
            "790000030104",
        ),
    ),
)

# Province names of the sales sheet that differ from the branch names.
PROVINCE_ALIASES = {"Vũng Tàu": "Bà Rịa - Vũng Tàu", "Huế": "Thừa Thiên Huế"}
