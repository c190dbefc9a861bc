"""Watermarks, date windows, new invoices, missing and completed parties, ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.catalog import query, sql
from netdays.functions import dates
from netdays.operators import incremental
from netdays.operators.ids import dense_ids
from netdays.params import SAMPLE_CUSTOMER
from netdays.plans.runs import append_checked
from netdays.session import new_scratch_path
from netdays.sources import files, standins
from netdays.sources.ledger import Ledger

_SPLIT_DAY = dt.date(1998, 7, 1)


@query(f"""
SELECT 'filled' AS ledger, coalesce(max(cast(o_orderdate AS date)), DATE '2001-10-31') AS watermark
FROM orders WHERE {sql.OFFERED}
UNION ALL
SELECT 'empty', coalesce(max(cast(o_orderdate AS date)), DATE '2001-10-31') FROM orders WHERE o_orderstatus = 'none'""")
def ledger_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark of the offers, and of a ledger without any."""
    filled = standins.offered_headers(spark, sf_dir)
    orders = standins.table(spark, sf_dir, "orders")
    empty = standins.as_headers(orders.filter(F.col("o_orderstatus") == "none"))
    return (
        incremental.watermark_table(filled, standins.AS_OF)
        .select(F.lit("filled").alias("ledger"), "watermark")
        .unionByName(
            incremental.watermark_table(empty, standins.AS_OF).select(
                F.lit("empty").alias("ledger"), "watermark"
            )
        )
    )


@query("""
WITH d AS (SELECT o_orderkey, cast(o_orderdate AS date) AS day FROM orders)
SELECT o_orderkey, day, strftime(day, '%d-%m-%Y') AS dayMonthYear,
  upper(strftime(day, '%d-%b-%Y')) AS dayMonYear,
  strptime(strftime(day, '%d-%m-%Y'), '%d-%m-%Y')::date AS parsed,
  cast(date_trunc('month', day) AS date) AS monthStart,
  cast(day - INTERVAL 2 MONTH AS date) AS lookback,
  day >= DATE '1998-07-01' AS fromDay,
  day BETWEEN DATE '1998-01-01' AND DATE '1998-07-01' AS closedWindow,
  day > DATE '1998-01-01' AND day < DATE '1998-07-01' AS openWindow,
  day = DATE '1998-07-01' AS onDay
FROM d""")
def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window predicates on the stored time, and the date texts of the wire."""
    first = dt.date(1998, 1, 1)
    time = F.col("o_orderdate")
    day = time.cast("date")
    return standins.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("day"),
        dates.day_month_year(day).alias("dayMonthYear"),
        dates.day_mon_year(day).alias("dayMonYear"),
        dates.parse_day_month_year(dates.day_month_year(day)).alias("parsed"),
        F.trunc(day, "month").alias("monthStart"),
        dates.lookback_start(day).alias("lookback"),
        dates.on_or_after(time, _SPLIT_DAY).alias("fromDay"),
        dates.in_closed_window(time, first, _SPLIT_DAY).alias("closedWindow"),
        dates.in_open_window(time, first, _SPLIT_DAY).alias("openWindow"),
        dates.on_day(time, _SPLIT_DAY).alias("onDay"),
    )


@query(f"""
WITH wm AS (SELECT max(cast(o_orderdate AS date)) AS d FROM orders WHERE {sql.OFFERED})
SELECT o_orderkey AS invoiceNumber, cast(o_orderdate AS date) AS invoiceDate FROM orders
WHERE cast(o_orderdate AS date) >= (SELECT d FROM wm) AND NOT ({sql.OFFERED})""")
def new_invoices_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Since the watermark, its day included, without those already offered."""
    offered = standins.offered_headers(spark, sf_dir)
    since = incremental.watermark(offered, standins.AS_OF)
    headers = standins.invoice_headers(spark, sf_dir, since).select("invoiceNumber", "invoiceDate")
    return incremental.not_yet_offered(headers, offered, "invoiceNumber")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger knows the customers of all market segments but one."""
    return standins.customers(spark, sf_dir, F.col("c_mktsegment") != "BUILDING")


@query("""
SELECT DISTINCT o_custkey AS customerNumber FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def missing_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = standins.invoice_headers(spark, sf_dir)
    return incremental.missing_parties(headers, _known(spark, sf_dir), "customerNumber")


@query(f"""
WITH {sql.CUSTOMERS}
SELECT c_custkey AS customerNumber, customerKey, c_name AS name, creditTerms FROM parties
WHERE c_mktsegment <> 'BUILDING' OR c_custkey IN (SELECT o_custkey FROM orders)""")
def complete_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known customers and those the invoices ask for, as one set."""
    known = _known(spark, sf_dir)
    missing = missing_parties(spark, sf_dir)
    fetched = incremental.only_keys(standins.customers(spark, sf_dir), missing, "customerNumber")
    return incremental.complete_parties(known, fetched).select(
        "customerNumber", "customerKey", "name", "creditTerms"
    )


@query("""
SELECT o_orderkey, o_custkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders""")
def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids without gaps, in key order, from 1001 on."""
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_ids(orders, "id", first=1001, order=["o_orderkey"])


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, invoiceDate, customerId, creditAmount, discountRate,
  cast(discountPercentage AS decimal(14,4)) AS discountPercentage, offeredPaymentDate,
  'not_sent' AS offerStatus
FROM ({sql.receivable_offers(SAMPLE_CUSTOMER)})""")
def ledger_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers written to an empty ledger in two runs, the second adding none, and read back."""
    from netdays.catalog.receivable import ar_offers

    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    ledger.create()
    for _ in range(2):
        offers = ar_offers(spark, sf_dir).withColumn("offerStatus", F.lit("not_sent"))
        held = ledger.read("customerOffers").select("invoiceNumber")
        fresh = incremental.not_yet_offered(offers, held, "invoiceNumber")
        append_checked(ledger, "customerOffers", fresh, "customerOfferId")
    return ledger.read("customerOffers").select(
        "invoiceNumber", "invoiceDate", "customerId", "creditAmount", "discountRate",
        "discountPercentage", "offeredPaymentDate", "offerStatus",
    )


@query(f"""
SELECT c_custkey AS "Customer_No", c_name AS "Customer_Name", {sql.CUSTOMER_TERMS} AS "Terms",
  'ar' || c_custkey || '@example.com' AS email,
  DATE '2014-01-01' + cast(c_custkey % 3650 AS integer) AS "Entered_date" FROM customer""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer master written as CSV and read with its declared schema."""
    from netdays.schemas import CUSTOMER_MASTER_CSV

    number = F.col("customerNumber")
    entered = F.date_add(F.lit(dt.date(2014, 1, 1)), (number % 3650).cast("int"))
    rows = standins.customers(spark, sf_dir).select(
        number.alias("Customer_No"),
        F.col("name").alias("Customer_Name"),
        F.col("creditTerms").alias("Terms"),
        "email",
        F.date_format(entered, files.ISO_DATE).alias("Entered_date"),
    )
    path = new_scratch_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, CUSTOMER_MASTER_CSV, dates=["Entered_date"])
