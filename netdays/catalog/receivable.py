"""Receivable offers and invoice consolidation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netdays.catalog import query, sql
from netdays.functions import dates, terms
from netdays.operators.consolidate import consolidate_lines, consolidate_to_headers
from netdays.operators.incremental import not_yet_offered, only_keys, watermark
from netdays.operators.pricing import gross_interest, price_whole_term
from netdays.params import CAPPED_CUSTOMER, SAMPLE_CUSTOMER, CustomerParams
from netdays.plans.receivables import receivable_offers
from netdays.session import new_scratch_path
from netdays.sources import files, receivables, standins
from netdays.sources.ledger import Ledger
from netdays.streaming.offers import customer_offer_stream, file_stream


def new_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices since the watermark without an offer, consolidated, with customer key."""
    offered = standins.offered_headers(spark, sf_dir)
    since = watermark(offered, standins.AS_OF)
    headers = standins.invoice_headers(spark, sf_dir, since)
    headers = not_yet_offered(headers, offered, "invoiceNumber")
    invoices = consolidate_to_headers(headers, standins.invoice_lines(spark, sf_dir))
    return standins.with_customer_key(invoices, spark, sf_dir)


def _offers(spark: SparkSession, sf_dir: str, params: CustomerParams) -> DataFrame:
    return receivable_offers(
        new_invoices(spark, sf_dir),
        standins.customers(spark, sf_dir),
        params,
    )


@query(sql.receivable_offers(SAMPLE_CUSTOMER))
def ar_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _offers(spark, sf_dir, SAMPLE_CUSTOMER)


@query(sql.receivable_offers(CAPPED_CUSTOMER))
def ar_offers_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _offers(spark, sf_dir, CAPPED_CUSTOMER)


@query(f"""
WITH flat AS (
  SELECT o_orderkey, cast(o_orderdate AS date) AS invoiceDate, o_custkey, {sql.CURRENCY} AS currency,
    {sql.PARTY_KEY} AS customerKey, {sql.LINE_GROSS} AS gross,
    l_linenumber * 1000000000000000000 + l_partkey * 10000000 + l_suppkey % 10000000 AS ord
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
)
SELECT o_orderkey AS invoiceNumber, cast(coalesce(sum(gross), 0) AS decimal(20,2)) AS invoiceGrossValue,
  arg_min(invoiceDate, ord) AS invoiceDate, arg_min(o_custkey, ord) AS customerNumber,
  arg_min(currency, ord) AS invoiceCurrencyCode, arg_min(customerKey, ord) AS customerKey
FROM flat WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey""")
def ar_invoice_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat lines, each with the columns of its invoice, to invoices."""
    headers = standins.invoice_headers(spark, sf_dir)
    headers = standins.with_customer_key(headers, spark, sf_dir)
    lines = headers.join(standins.invoice_lines(spark, sf_dir), "invoiceNumber")
    return consolidate_lines(lines, standins.LINE_ORDER)


@query(f"""
WITH {sql.INVOICES}
SELECT invoiceNumber, invoiceDate, customerNumber, currency AS invoiceCurrencyCode,
  gross AS invoiceGrossValue FROM invoices""")
def ar_invoice_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines summed onto one-row-per-invoice headers."""
    headers = standins.invoice_headers(spark, sf_dir)
    return consolidate_to_headers(headers, standins.invoice_lines(spark, sf_dir))


@query(f"""
SELECT cast(o_orderkey AS varchar) AS invoiceNumber, cast(o_orderdate AS date) AS invoiceDate,
  cast(o_custkey AS varchar) AS customerNumber, {sql.LINE_GROSS} AS invoiceGrossValue,
  {sql.CURRENCY} AS invoiceCurrencyCode, l_partkey AS itemId,
  {sql.normalized("' ' || n_name || '-' || o_orderpriority")} || '_' || o_custkey AS customerKey,
  CASE WHEN p_brand <> 'Brand#1' THEN cast(p_retailprice AS decimal(12,2)) END AS "unitCost",
  p_name AS "productCode", cast(p_size AS varchar) AS "skuSize", p_type AS "subVariant"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN part ON p_partkey = l_partkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01'""")
def ar_invoice_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines since a day, with customer key, unit cost and item attributes."""
    relations = standins.receivable_relations(spark, sf_dir)
    lines = receivables.invoice_lines(relations, dt.date(1996, 1, 1))
    return receivables.with_item_details(lines, relations).select(
        "invoiceNumber", "invoiceDate", "customerNumber", "invoiceGrossValue",
        "invoiceCurrencyCode", "itemId", "customerKey",
        F.col("unitCost").cast("decimal(12,2)").alias("unitCost"),
        "productCode", "skuSize", "subVariant",
    )


@query(f"""
WITH {sql.INVOICES}, {sql.CUSTOMERS}
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, invoiceDate,
  cast(customerNumber AS varchar) AS customerNumber, gross AS invoiceGrossValue,
  currency AS invoiceCurrencyCode, customerKey
FROM invoices JOIN parties ON c_custkey = customerNumber""")
def ar_invoice_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines exported as CSV under the ERP's headers, read and consolidated."""
    headers = standins.invoice_headers(spark, sf_dir)
    headers = headers.join(standins.ship_to(spark, sf_dir), "customerNumber")
    lines = headers.join(standins.invoice_lines(spark, sf_dir), "invoiceNumber")
    path = new_scratch_path(spark, "invoice-file")
    names = [F.col(new).alias(old) for old, new in files.RECEIVABLE_HEADERS.items()]
    files.write_csv(lines.select(*names, "lineId"), path)
    schema = ", ".join(f"`{c}` string" for c in files.RECEIVABLE_HEADERS) + ", lineId bigint"
    stored = files.read_csv(spark, path, StructType.fromDDL(schema))
    return consolidate_lines(files.receivable_lines(stored, ["lineId"]), ["lineId"])


# Parameters of the earlier pricing forms: a 0.6 % cost makes the cap bind.
_WHOLE_TERM = CustomerParams(
    exchange_rate="160", cost_of_finance_per_day="0.6", max_discount="9", share_of_savings="40",
    tiers={14: 7, 21: 14, 30: 15, 60: 30}, minimum_amount="10000",
)


def _termed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All consolidated invoices of customers on readable terms."""
    days = terms.leading_days(F.col("creditTerms"))
    parties = standins.customers(spark, sf_dir).select("customerNumber", days.alias("termDays"))
    headers = standins.invoice_headers(spark, sf_dir)
    invoices = consolidate_to_headers(headers, standins.invoice_lines(spark, sf_dir))
    joined = invoices.join(parties.filter(F.col("termDays").isNotNull()), "customerNumber")
    return joined.withColumn("paymentDate", F.date_add("invoiceDate", F.col("termDays")))


_TERMED = f"""{sql.INVOICES}, {sql.CUSTOMERS},
termed AS (
  SELECT i.*, try_cast(split_part(creditTerms, ' ', 1) AS integer) AS days
  FROM invoices i JOIN parties ON c_custkey = customerNumber
  WHERE try_cast(split_part(creditTerms, ' ', 1) AS integer) IS NOT NULL
)"""
# A rate near 1 leaves offers below a cap that is measured before conversion.
_ALL_CONVERTED = CustomerParams(
    exchange_rate="1.25", cost_of_finance_per_day="0.6", max_discount="9", share_of_savings="40",
    tiers=_WHOLE_TERM.tiers, minimum_amount="10000",
)
_WHOLE_TERM_COLUMNS = (
    "invoiceNumber", "termDays", "baseValue", "grossFinance", "maxAllowedOffer",
    "discountAmount", "offerAvailableDate",
)


def _whole_term_sql(
    value: str, capped: str, keep: str, only: str = "TRUE", start: str = "invoiceDate"
) -> str:
    early = sql.tier_case("days", dict(_WHOLE_TERM.tiers))
    return f"""
WITH {_TERMED},
valued AS (SELECT *, cast({value} AS decimal(20,2)) AS baseValue FROM termed WHERE gross >= 10000 AND {only}),
priced AS (
  SELECT invoiceNumber, days AS termDays, baseValue,
    cast(baseValue * (cast(days AS decimal(10,0)) * cast(0.006 AS decimal(4,3))) AS decimal(20,4)) AS grossFinance,
    cast({capped} * cast(0.09 AS decimal(3,2)) AS decimal(20,4)) AS maxAllowedOffer,
    cast(baseValue * (cast(days AS decimal(10,0)) * cast(0.0024 AS decimal(5,4))) AS decimal(20,4)) AS discountAmount,
    cast({start} + cast({early} AS integer) AS date) AS offerAvailableDate
  FROM valued
)
SELECT * FROM priced WHERE maxAllowedOffer {keep} discountAmount"""


_USD_VALUE = "CASE WHEN currency = 'USD' THEN gross * 160 ELSE gross END"


@query(_whole_term_sql(_USD_VALUE, "baseValue", ">="))
def notebook_offer_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-term cost, offers up to and including the cap."""
    return price_whole_term(_termed(spark, sf_dir), _WHOLE_TERM, ">=").select(*_WHOLE_TERM_COLUMNS)


@query(_whole_term_sql(_USD_VALUE, "baseValue", ">", "days IN (14, 21, 30, 60)", "invoiceDate + days"))
def notebook_offer_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-term cost, offers below the cap, only terms with a tier, from the payment date."""
    offers = price_whole_term(
        _termed(spark, sf_dir), _WHOLE_TERM, ">", available_from="paymentDate", strict_tiers=True
    )
    return offers.select(*_WHOLE_TERM_COLUMNS)


@query(_whole_term_sql("gross * 1.25", "gross", ">"))
def notebook_offer_all_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that converts every row and measures the cap before conversion."""
    offers = price_whole_term(_termed(spark, sf_dir), _ALL_CONVERTED, ">", convert="all")
    return offers.select(*_WHOLE_TERM_COLUMNS)


@query(f"""
WITH {_TERMED},
valued AS (SELECT *, cast({_USD_VALUE} AS decimal(20,2)) AS baseValue FROM termed)
SELECT invoiceNumber, days AS termDays, baseValue,
  cast(baseValue * (cast(days AS decimal(10,0)) + cast(0.002 AS decimal(4,3))) AS decimal(20,4)) AS grossInterest
FROM valued""")
def notebook_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gross_interest(_termed(spark, sf_dir), SAMPLE_CUSTOMER).select(
        "invoiceNumber", "termDays", "baseValue", "grossInterest"
    )


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, invoiceDate, customerId, customerKey,
  creditAmount, discountRate, cast(discountPercentage AS decimal(14,4)) AS discountPercentage,
  originalPaymentDate, offeredPaymentDate, totalInterest, 'not_sent' AS offerStatus
FROM ({sql.receivable_offers(SAMPLE_CUSTOMER)})""")
def streaming_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as a file stream, priced batch by batch into a ledger."""
    stored = standins.table(spark, sf_dir, "orders").schema
    offered = standins.offered_headers(spark, sf_dir)
    since = watermark(offered, standins.AS_OF)
    orders = file_stream(spark, sf_dir, stored, pattern="orders.parquet")
    headers = orders.filter(dates.on_or_after(F.col("o_orderdate"), since)).transform(
        standins.as_headers
    )
    ledger = Ledger(spark, new_scratch_path(spark, "streamed-ledger"))

    def to_invoices(batch: DataFrame) -> DataFrame:
        lines = standins.invoice_lines(batch.sparkSession, sf_dir)
        lines = only_keys(lines, batch.select("invoiceNumber"), "invoiceNumber")
        invoices = consolidate_to_headers(batch, lines)
        return standins.with_customer_key(invoices, batch.sparkSession, sf_dir)

    customer_offer_stream(
        headers,
        to_invoices,
        standins.customers(spark, sf_dir),
        ledger,
        SAMPLE_CUSTOMER,
        new_scratch_path(spark, "stream-state"),
        offered_elsewhere=offered,
    ).awaitTermination()
    return ledger.read("customerOffers").select(
        "invoiceNumber", "invoiceDate", "customerId", "customerKey", "creditAmount",
        "discountRate", "discountPercentage", "originalPaymentDate", "offeredPaymentDate",
        "totalInterest", "offerStatus",
    )
