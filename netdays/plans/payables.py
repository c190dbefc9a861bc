"""Payables: from supplier invoices to priced early-payment offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.functions import keys, money, terms
from netdays.operators.incremental import not_yet_offered
from netdays.operators.pricing import price_payables
from netdays.params import SupplierParams

OFFER_COLUMNS = (
    "invoiceUniqueKey", "invoiceDate", "vendorId", "invoiceNumber", "supplierId", "termDays",
    "creditAmount", "discountAmount", "discountRate", "discountPercentage",
    "originalPaymentDate", "offeredPaymentDate",
)


def canonical_invoices(extract: DataFrame, with_gl_date: bool = False) -> DataFrame:
    """Key and base-currency gross of the ERP's invoices, exact repeats removed.

    Repeats combine before the shuffle, so many copies of one invoice leave each
    map task as one row; the key, made of two of the columns, is added after it.
    The GL date takes no part in what makes a repeat; when asked for it is the
    last one of the copies.
    """
    plain = ["invoiceDate", "vendorId", "invoiceNumber", "invoiceGrossValue"]
    invoices = extract.withColumn(
        "invoiceGrossValue",
        money.in_base_currency(F.col("amount"), F.col("currency"), F.col("rate")),
    )
    if with_gl_date:
        single = invoices.groupBy(*plain).agg(F.max("glDate").alias("glDate"))
    else:
        single = invoices.select(*plain).distinct()
    return single.withColumn(
        "invoiceUniqueKey", keys.invoice_key(F.col("vendorId"), F.col("invoiceNumber"))
    )


def eligible_suppliers(suppliers: DataFrame) -> DataFrame:
    """Vendor, id and days of suppliers on "days net" terms of more than a week."""
    return (
        suppliers.filter(terms.is_days_net(F.col("creditTerms")))
        .select("vendorId", "supplierId", terms.first_digits(F.col("creditTerms")).alias("termDays"))
        .filter(terms.long_enough(F.col("termDays")))
    )


def payable_offers(
    invoices: DataFrame,
    suppliers: DataFrame,
    offered: DataFrame,
    params: SupplierParams,
) -> DataFrame:
    """Offers for canonical invoices that have none yet; one supplier row per vendor."""
    new = not_yet_offered(invoices, offered, "invoiceUniqueKey")
    enriched = new.join(eligible_suppliers(suppliers), "vendorId", "inner").filter(
        terms.has_due_date(F.col("invoiceDate"), F.col("termDays"))
    )
    return (
        price_payables(enriched, params)
        .withColumnRenamed("invoiceGrossValue", "creditAmount")
        .select(*OFFER_COLUMNS, *[c for c in ("glDate",) if c in invoices.columns])
    )


def unparsable_terms(invoices: DataFrame, suppliers: DataFrame) -> DataFrame:
    """New invoices on "days net" terms without a number of days, or with one that leads
    to no date."""
    stated = suppliers.filter(terms.is_days_net(F.col("creditTerms"))).select(
        "vendorId", "creditTerms", terms.first_digits(F.col("creditTerms")).alias("_days")
    )
    return terms.without_due_date(invoices.join(stated, "vendorId", "inner"))
