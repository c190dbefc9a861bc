"""Receivables: from invoice headers and lines to priced customer offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.functions import terms
from netdays.operators.pricing import price_receivables
from netdays.params import CustomerParams

OFFER_COLUMNS = (
    "invoiceNumber", "invoiceDate", "customerId", "customerKey", "termDays",
    "creditAmount", "savedAmount", "maxAllowedOffer", "totalInterest", "discountedAmount",
    "discountRate", "discountPercentage", "netPayableBase", "discountPctOfCredit",
    "originalPaymentDate", "offeredPaymentDate",
)


def eligible_customers(customers: DataFrame) -> DataFrame:
    """Key, id and days of customers on "N Days Net" terms of more than a week.

    Parsed once per customer, not once per invoice, and small beside them.
    """
    return (
        customers.filter(terms.is_days_net(F.col("creditTerms")))
        .select("customerKey", "customerId", terms.leading_days(F.col("creditTerms")).alias("termDays"))
        .filter(terms.long_enough(F.col("termDays")))
    )


def receivable_offers(
    invoices: DataFrame, customers: DataFrame, params: CustomerParams
) -> DataFrame:
    """Offers for consolidated invoices that have none yet.

    Leave out the offered ones by ``not_yet_offered`` while the rows are still
    partitioned by invoice number, before they are keyed by customer.
    ``customers`` holds one row per ``customerKey``. Joining only the eligible
    ones is the outer join followed by the terms filter, which drops the
    unmatched rows. The invoice side of that join is a plain shuffle, so
    adaptive execution can split a customer that holds a large share of it.
    """
    enriched = invoices.join(eligible_customers(customers), "customerKey", "inner").filter(
        terms.has_due_date(F.col("invoiceDate"), F.col("termDays"))
    )
    return price_receivables(enriched, params).select(*OFFER_COLUMNS)


def unparsable_terms(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """New invoices on "days net" terms that do not start with a number of days, or with
    one that leads to no date."""
    stated = customers.filter(terms.is_days_net(F.col("creditTerms"))).select(
        "customerKey", "creditTerms", terms.leading_days(F.col("creditTerms")).alias("_days")
    )
    return terms.without_due_date(invoices.join(stated, "customerKey", "inner"))
