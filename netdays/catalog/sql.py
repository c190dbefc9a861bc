"""SQL fragments shared by the checks: the stand-in model, written for DuckDB."""

from __future__ import annotations

from netdays.params import CustomerParams, SupplierParams


def normalized(expression: str) -> str:
    return f"coalesce(regexp_replace(lower(trim({expression})), '[^a-z0-9]', '', 'g'), '')"


def terms_case(number: str, texts: tuple) -> str:
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if t is None else f"'{t}'") for i, t in enumerate(texts)
    )
    return f"CASE {number} % {len(texts)} {whens} END"


LINE_GROSS = (
    "cast(cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2)))"
    " * (1 + cast(l_tax AS decimal(4,2))) AS decimal(18,2))"
)
CURRENCY = (
    "CASE WHEN o_orderkey % 10 <= 2 THEN 'USD' WHEN o_orderkey % 10 = 3 THEN 'GBP' ELSE 'KES' END"
)
SITE = "' ' || n_name || '-' || c_mktsegment"
PARTY_KEY = f"{normalized(SITE)} || '_' || cast(c_custkey AS varchar)"
CUSTOMER_TERMS = terms_case(
    "c_custkey",
    ("30 Days Net", "14 days net", "21 Days Net", "45 Days Net", "60 Days Net",
     "7 Days Net", "Immediate", "10000 Days Net", None),
)
SUPPLIER_TERMS = terms_case(
    "s_suppkey",
    ("30 Days Net", "Net 15 Days Net", "20 days NET", "45 Days Net", "60 Days Net",
     "90 Days Net", "12000 Days Net", "Days Net", None),
)
AP_NUMBER = "cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar)"
AP_KEY = f"cast(l_suppkey AS varchar) || '_' || {AP_NUMBER}"
AP_TAX = (
    "cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_tax AS decimal(4,2)) AS decimal(18,2))"
)

# CTE: one row per invoice of all orders that have lines.
INVOICES = f"""
line_sums AS (
  SELECT l_orderkey, cast(sum({LINE_GROSS}) AS decimal(20,2)) AS gross
  FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey
),
invoices AS (
  SELECT o_orderkey AS invoiceNumber, cast(o_orderdate AS date) AS invoiceDate,
         o_custkey AS customerNumber, {CURRENCY} AS currency, gross
  FROM orders JOIN line_sums ON l_orderkey = o_orderkey
)"""

# CTE: the ledger's customers.
CUSTOMERS = f"""
parties AS (
  SELECT c_custkey, {PARTY_KEY} AS customerKey, {CUSTOMER_TERMS} AS creditTerms, c_name, c_mktsegment
  FROM customer JOIN nation ON n_nationkey = c_nationkey
)"""

OFFERED = "o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus = 'F'"


def tier_case(days: str, values: dict[int, object], default: str = "0") -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in sorted(values.items()))
    return f"CASE {days} {whens} ELSE {default} END"


# CTEs: what is new since the watermark, with the terms of its customer.
FRESH = f"""
{CUSTOMERS},
wm AS (SELECT coalesce(max(cast(o_orderdate AS date)), DATE '2001-10-31') AS d FROM orders WHERE {OFFERED}),
fresh AS (
  SELECT i.*, p.customerKey, p.c_custkey AS customerId,
         try_cast(split_part(p.creditTerms, ' ', 1) AS integer) AS days
  FROM invoices i LEFT JOIN parties p ON p.c_custkey = i.customerNumber
  WHERE i.invoiceDate >= (SELECT d FROM wm)
    AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = i.invoiceNumber AND {OFFERED})
    AND lower(p.creditTerms) LIKE '%days net%'
)"""


def receivable_offers(params: CustomerParams, fresh: str | None = None) -> str:
    """The priced offers, from the sample parameters as plain SQL literals.

    ``fresh`` replaces the CTEs that give the new invoices with key and days.
    """
    cost = f"{params.cost_of_finance_per_day / 100:f}"
    share = f"{params.share_of_savings / 100:f}"
    cap = f"{params.max_discount / 100:f}"
    early = tier_case("days", dict(params.tiers))
    return f"""
WITH {INVOICES}, {fresh or FRESH},
credited AS (
  SELECT *, cast({early} AS integer) AS early,
         cast(CASE WHEN currency = 'USD' THEN gross * {params.exchange_rate} ELSE gross END AS decimal(20,2)) AS credit
  FROM fresh WHERE days > 7
),
priced AS (
  SELECT *,
    cast(credit * (cast(early AS decimal(10,0)) * cast({cost} AS decimal(5,4))) AS decimal(20,4)) AS savedAmount,
    cast(credit * cast({cap} AS decimal(3,2)) AS decimal(20,4)) AS maxAllowedOffer,
    cast(credit * (cast(days AS decimal(10,0)) * cast({cost} AS decimal(5,4))) AS decimal(20,4)) AS totalInterest,
    credit * (cast(early AS decimal(10,0)) * (cast({cost} AS decimal(5,4)) * cast({share} AS decimal(3,2)))) AS wanted,
    credit * cast({cap} AS decimal(3,2)) AS cap
  FROM credited
),
cut AS (
  SELECT *, cast(CASE WHEN wanted < cap THEN wanted ELSE cap END AS decimal(20,4)) AS discountedAmount FROM priced
)
SELECT invoiceNumber, invoiceDate, customerId, customerKey, days AS termDays,
  credit AS creditAmount, savedAmount, maxAllowedOffer, totalInterest, discountedAmount,
  cast(gross - discountedAmount AS decimal(20,4)) AS discountRate,
  round(cast(discountedAmount AS double) / nullif(cast(gross AS double), 0) * 100, 4) AS discountPercentage,
  cast(credit - discountedAmount AS decimal(20,4)) AS netPayableBase,
  round(cast(discountedAmount AS double) / nullif(cast(credit AS double), 0) * 100, 4) AS discountPctOfCredit,
  cast(invoiceDate + days AS date) AS originalPaymentDate,
  cast(invoiceDate + days - early AS date) AS offeredPaymentDate
FROM cut"""


# CTE: supplier invoices as the ERP view gives them.
PAYABLES = f"""
payables AS (
  SELECT l_suppkey AS vendorId, {AP_NUMBER} AS invoiceNumber, {AP_KEY} AS invoiceUniqueKey,
    cast(l_shipdate AS date) AS invoiceDate, cast(l_shipdate AS date) + 3 AS glDate,
    {LINE_GROSS} AS amount, {AP_TAX} AS tax, l_quantity AS distributionTotal, l_returnflag,
    CASE WHEN l_suppkey % 4 = 0 THEN 'USD' ELSE 'KES' END AS currency,
    CASE WHEN l_suppkey % 16 = 0 THEN cast(129.123456 AS decimal(19,10)) WHEN l_suppkey % 16 = 8 THEN cast(0.000123456 AS decimal(19,10))
         WHEN l_suppkey % 4 = 0 THEN cast(129.50 AS decimal(19,10)) END AS rate
  FROM lineitem
)"""
AP_OFFERED = "l_shipdate < TIMESTAMP '2000-01-01' AND l_linestatus = 'F'"


def in_base(amount: str) -> str:
    return f"cast(CASE WHEN currency = 'USD' THEN {amount} * rate ELSE {amount} END AS decimal(20,2))"


def payable_offers(
    params: SupplierParams,
    gl_from: str = "(SELECT d FROM wm)",
    suppliers: str = "TRUE",
    offered: str = AP_OFFERED,
) -> str:
    early = tier_case("days", {k: t.early_days for k, t in params.tiers.items()})
    percent = tier_case(
        "days",
        {k: f"cast({t.percent} AS decimal(7,4))" for k, t in params.tiers.items()},
        "cast(0 AS decimal(7,4))",
    )
    return f"""
WITH {PAYABLES},
wm AS (SELECT coalesce(max(cast(l_shipdate AS date)), DATE '2001-10-31') AS d FROM lineitem WHERE {AP_OFFERED}),
canonical AS (
  SELECT DISTINCT invoiceUniqueKey, invoiceDate, vendorId, invoiceNumber, {in_base('amount')} AS gross
  FROM payables WHERE glDate BETWEEN {gl_from} AND DATE '2001-12-31'
),
fresh AS (
  SELECT c.*, s_suppkey AS supplierId,
    try_cast(nullif(regexp_extract({SUPPLIER_TERMS}, '\\d+'), '') AS integer) AS days
  FROM canonical c LEFT JOIN supplier ON s_suppkey = c.vendorId
  WHERE lower({SUPPLIER_TERMS}) LIKE '%days net%' AND {suppliers}
    AND NOT EXISTS (SELECT 1 FROM lineitem WHERE {AP_KEY} = c.invoiceUniqueKey AND {offered})
),
tiered AS (SELECT *, {early} AS early, {percent} AS percent FROM fresh WHERE days > 7),
priced AS (
  SELECT *, cast(gross * (percent * cast(0.01 AS decimal(3,2))) AS decimal(20,4)) AS discountAmount FROM tiered
)
SELECT invoiceUniqueKey, invoiceDate, vendorId, invoiceNumber, supplierId, days AS termDays,
  gross AS creditAmount, discountAmount,
  cast(gross - discountAmount AS decimal(20,4)) AS discountRate, percent AS discountPercentage,
  cast(invoiceDate + days AS date) AS originalPaymentDate,
  cast(invoiceDate + days - early AS date) AS offeredPaymentDate
FROM priced"""
