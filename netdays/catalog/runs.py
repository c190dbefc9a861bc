"""Whole incremental runs against a new ledger, from the ERP's relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from netdays.catalog import query, sql
from netdays.catalog.parties import SITE_SQL
from netdays.params import SAMPLE_CUSTOMER, SAMPLE_SUPPLIER
from netdays.plans.runs import run_payables, run_receivables
from netdays.session import new_scratch_path
from netdays.sources import standins
from netdays.sources.ledger import Ledger

# Two months before it lies the first invoice date of the receivable run.
_FIRST_AS_OF = dt.date(2000, 2, 29)

_FRESH = f"""
master AS (
  SELECT customerKey, arg_min(creditTerms, cast(siteUseId AS bigint)) AS creditTerms
  FROM ({SITE_SQL}) GROUP BY customerKey
),
fresh AS (
  SELECT i.invoiceNumber, i.invoiceDate, i.currency, i.gross, m.customerKey, 0 AS customerId,
    try_cast(split_part(m.creditTerms, ' ', 1) AS integer) AS days
  FROM invoices i JOIN orders ON o_orderkey = i.invoiceNumber
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN master m ON m.customerKey =
    {sql.normalized("' ' || n_name || '-' || o_orderpriority")} || '_' || c_custkey
  WHERE i.invoiceDate >= DATE '1999-12-29' AND lower(m.creditTerms) LIKE '%days net%'
)"""


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, invoiceDate, customerKey, creditAmount,
  discountRate, cast(discountPercentage AS decimal(14,4)) AS discountPercentage, totalInterest,
  originalPaymentDate, offeredPaymentDate, 'not_sent' AS offerStatus
FROM ({sql.receivable_offers(SAMPLE_CUSTOMER, _FRESH)})""")
def ar_ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first receivable run and a second one, which finds nothing new."""
    relations = standins.receivable_relations(spark, sf_dir)
    ledger = Ledger(spark, new_scratch_path(spark, "ar-ledger"))
    run_receivables(ledger, relations, SAMPLE_CUSTOMER, _FIRST_AS_OF)
    run_receivables(ledger, relations, SAMPLE_CUSTOMER, standins.AS_OF)
    return ledger.read("customerOffers").select(
        "invoiceNumber", "invoiceDate", "customerKey", "creditAmount", "discountRate",
        "discountPercentage", "totalInterest", "originalPaymentDate", "offeredPaymentDate",
        "offerStatus",
    )


_AP = sql.payable_offers(
    SAMPLE_SUPPLIER,
    gl_from="DATE '2000-04-30'",
    suppliers="s_suppkey % 7 NOT IN (0, 1)",
    offered="FALSE",
)


# Some keys occur twice, with other amounts: the second run leaves out those that
# the first one, up to its GL date, has offered.
_IN_FIRST_RUN = "invoiceDate + 3 <= DATE '2000-06-30'"


@query(f"""
WITH offers AS ({_AP}), first_run AS (SELECT invoiceUniqueKey FROM offers WHERE {_IN_FIRST_RUN})
SELECT invoiceUniqueKey, invoiceDate, vendorId, invoiceNumber, creditAmount, discountRate,
  cast(discountPercentage AS decimal(14,4)) AS discountPercentage, originalPaymentDate,
  offeredPaymentDate, 'not_sent' AS offerStatus
FROM offers WHERE {_IN_FIRST_RUN} OR invoiceUniqueKey NOT IN (SELECT invoiceUniqueKey FROM first_run)""")
def ap_ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two payable runs; the second starts at the last GL date of the first."""
    relations = standins.supplier_side_relations(spark, sf_dir)
    ledger = Ledger(spark, new_scratch_path(spark, "ap-ledger"))
    run_payables(ledger, relations, SAMPLE_SUPPLIER, dt.date(2000, 6, 30), org_id=82)
    run_payables(ledger, relations, SAMPLE_SUPPLIER, standins.AS_OF, org_id=82)
    return ledger.read("supplierPayment").select(
        "invoiceUniqueKey", "invoiceDate", "vendorId", "invoiceNumber", "creditAmount",
        "discountRate", "discountPercentage", "originalPaymentDate", "offeredPaymentDate",
        "offerStatus",
    )
