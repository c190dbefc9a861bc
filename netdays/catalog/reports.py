"""Offer reports, the invoice/customer join and status updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.catalog import query, sql
from netdays.catalog.payable import ap_offers
from netdays.catalog.receivable import ar_offers
from netdays.operators.updates import update_column, updates_without_row
from netdays.params import SAMPLE_CUSTOMER, SAMPLE_SUPPLIER
from netdays.plans import reports
from netdays.session import new_scratch_path
from netdays.sources import standins

_AR = sql.receivable_offers(SAMPLE_CUSTOMER)
_AP = sql.payable_offers(SAMPLE_SUPPLIER)


@query(f"""
WITH {sql.CUSTOMERS}
SELECT o.*, p.c_custkey AS "partyCustomerId", p.c_custkey AS customerNumber, p.c_name AS name,
  'ar' || p.c_custkey || '@example.com' AS email, 'ORGANIZATION' AS customerType, p.creditTerms
FROM ({_AR}) o LEFT JOIN parties p ON p.customerKey = o.customerKey""")
def offer_report_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_offer_report(
        ar_offers(spark, sf_dir), standins.customers(spark, sf_dir)
    )


@query(f"""
SELECT o.*, s_suppkey AS "partyVendorId", s_name AS name, 'ap' || s_suppkey || '@example.com' AS email,
  CASE WHEN s_suppkey % 7 = 0 THEN 'EMPLOYEE' WHEN s_suppkey % 7 = 1 THEN NULL ELSE 'VENDOR' END AS supplierType,
  {sql.SUPPLIER_TERMS} AS creditTerms
FROM ({_AP}) o LEFT JOIN supplier ON s_suppkey = o.supplierId""")
def offer_report_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.supplier_offer_report(
        ap_offers(spark, sf_dir), standins.suppliers(spark, sf_dir)
    )


@query(f"""
WITH {sql.CUSTOMERS}
SELECT invoiceNumber, name, creditAmount,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'accepted' WHEN '5-LOW' THEN 'rejected'
       ELSE 'not_sent' END AS offerStatus
FROM (SELECT o.invoiceNumber, p.c_name AS name, o.creditAmount FROM ({_AR}) o
      LEFT JOIN parties p ON p.customerKey = o.customerKey)
JOIN orders ON o_orderkey = invoiceNumber""")
def offer_report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after decisions, exported as CSV by status and read back."""
    offers = ar_offers(spark, sf_dir).select(
        "invoiceNumber", "customerKey", "creditAmount", F.lit("not_sent").alias("offerStatus")
    )
    decided = update_column(offers, _decisions(spark, sf_dir), "invoiceNumber", "offerStatus")
    report = reports.customer_offer_report(decided, standins.customers(spark, sf_dir))
    columns = ("invoiceNumber", "name", "creditAmount", "offerStatus")
    path = new_scratch_path(spark, "report")
    reports.export_by_status(report.select(*columns), path)
    schema = "invoiceNumber bigint, name string, creditAmount decimal(20,2), offerStatus string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query(f"""
WITH {sql.CUSTOMERS}
SELECT o_custkey AS customerNumber, o_orderkey AS invoiceNumber, cast(o_orderdate AS date) AS invoiceDate,
  {sql.CURRENCY} AS invoiceCurrencyCode, c_custkey AS customerId, customerKey, c_name AS name,
  'ar' || c_custkey || '@example.com' AS email, 'ORGANIZATION' AS customerType, creditTerms
FROM orders JOIN parties ON c_custkey = o_custkey""")
def invoice_customer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole invoice and customer rows, the invoice's columns winning."""
    return reports.invoices_with_customer(
        standins.invoice_headers(spark, sf_dir), standins.customers(spark, sf_dir), "customerNumber"
    )


@query(f"""
WITH {sql.CUSTOMERS}
SELECT o_orderkey AS invoiceNumber, c_name AS name, creditTerms
FROM orders JOIN parties ON c_custkey = o_custkey ORDER BY o_orderkey LIMIT 2""")
def invoice_customer_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two joined rows."""
    joined = invoice_customer_join(spark, sf_dir).select("invoiceNumber", "name", "creditTerms")
    return reports.preview(joined, ["invoiceNumber"], 2)


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders are accepted, low ones rejected; the key comes as text."""
    decision = F.when(F.col("o_orderpriority") == "1-URGENT", "accepted").when(
        F.col("o_orderpriority") == "5-LOW", "rejected"
    )
    return standins.table(spark, sf_dir, "orders").filter(decision.isNotNull()).select(
        F.col("o_orderkey").cast("string").alias("invoiceNumber"), decision.alias("offerStatus")
    )


@query(f"""
SELECT invoiceNumber, customerKey, discountedAmount,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'accepted' WHEN '5-LOW' THEN 'rejected'
       ELSE 'not_sent' END AS offerStatus
FROM ({_AR}) JOIN orders ON o_orderkey = invoiceNumber""")
def offer_status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers after a batch of decisions."""
    offers = ar_offers(spark, sf_dir).select(
        "invoiceNumber", "customerKey", "discountedAmount", F.lit("not_sent").alias("offerStatus")
    )
    return update_column(offers, _decisions(spark, sf_dir), "invoiceNumber", "offerStatus")


@query(f"""
SELECT cast(o_orderkey AS varchar) AS invoiceNumber,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'accepted' ELSE 'rejected' END AS offerStatus
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey NOT IN (SELECT invoiceNumber FROM ({_AR}))""")
def offer_status_update_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on invoices that have no offer."""
    return updates_without_row(
        ar_offers(spark, sf_dir), _decisions(spark, sf_dir), "invoiceNumber"
    )
