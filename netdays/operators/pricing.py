"""Offer pricing: every amount is a column expression over one row."""

from __future__ import annotations

from decimal import Decimal
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.functions import money
from netdays.operators.tiers import early_days, tier_percent
from netdays.params import CustomerParams, SupplierParams


def price_receivables(invoices: DataFrame, params: CustomerParams) -> DataFrame:
    """Offers to customers.

    Needs ``invoiceDate, termDays, invoiceGrossValue, invoiceCurrencyCode``.
    ``discountRate`` and ``discountPercentage`` set a base-currency discount
    against the invoice-currency gross, as users of these columns expect;
    ``netPayableBase`` and ``discountPctOfCredit`` stay within one currency.
    """
    cost = money.fraction(params.cost_of_finance_per_day)
    share = money.fraction(params.share_of_savings)
    cap = money.fraction(params.max_discount)
    days = F.col("termDays")
    saved_days = early_days(days, params)
    gross = F.col("invoiceGrossValue")
    credit = F.col("creditAmount")

    def per_day(count, factor: Decimal):
        return credit * (count.cast("decimal(10,0)") * money.literal(factor))

    if params.minimum_amount is not None:
        invoices = invoices.filter(gross >= money.literal(params.minimum_amount))
    rate = money.literal(params.exchange_rate)
    return (
        invoices.withColumn(
            "creditAmount",
            money.in_base_currency(gross, F.col("invoiceCurrencyCode"), rate),
        )
        .withColumns(
            {
                "originalPaymentDate": F.date_add("invoiceDate", days),
                "offeredPaymentDate": F.date_add("invoiceDate", days - saved_days),
                "savedAmount": per_day(saved_days, cost).cast(money.OFFER),
                "maxAllowedOffer": (credit * money.literal(cap)).cast(money.OFFER),
                "totalInterest": per_day(days, cost).cast(money.OFFER),
                "discountedAmount": money.smaller_or_second(
                    per_day(saved_days, cost * share), credit * money.literal(cap)
                ).cast(money.OFFER),
            }
        )
        .withColumns(
            {
                "discountRate": (gross - F.col("discountedAmount")).cast(money.OFFER),
                "discountPercentage": money.percent_of(F.col("discountedAmount"), gross),
                "netPayableBase": (credit - F.col("discountedAmount")).cast(money.OFFER),
                "discountPctOfCredit": money.percent_of(F.col("discountedAmount"), credit),
            }
        )
    )


def price_payables(invoices: DataFrame, params: SupplierParams) -> DataFrame:
    """Offers to suppliers. Needs ``invoiceDate, termDays, invoiceGrossValue``."""
    days = F.col("termDays")
    gross = F.col("invoiceGrossValue")
    percent = tier_percent(days, params)
    return invoices.withColumns(
        {
            "originalPaymentDate": F.date_add("invoiceDate", days),
            "offeredPaymentDate": F.date_add("invoiceDate", days - early_days(days, params)),
            "discountAmount": (gross * (percent * F.lit(Decimal("0.01")))).cast(money.OFFER),
            "discountPercentage": percent,
        }
    ).withColumn("discountRate", (gross - F.col("discountAmount")).cast(money.OFFER))


def price_whole_term(
    invoices: DataFrame,
    params: CustomerParams,
    keep: Literal[">=", ">"] = ">=",
    convert: Literal["usd", "all"] = "usd",
    available_from: str = "invoiceDate",
    strict_tiers: bool = False,
) -> DataFrame:
    """Earlier pricing forms: finance cost of the whole term, cap as a filter.

    An offer above the cap is left out rather than cut. ``convert="all"``
    applies the rate to every row and measures the cap in invoice currency;
    ``strict_tiers`` leaves out terms that have no tier.
    """
    cost = money.fraction(params.cost_of_finance_per_day)
    share = money.fraction(params.share_of_savings)
    cap = money.fraction(params.max_discount)
    gross = F.col("invoiceGrossValue")
    rate = money.literal(params.exchange_rate)
    days = F.col("termDays")

    if params.minimum_amount is not None:
        invoices = invoices.filter(gross >= money.literal(params.minimum_amount))
    if strict_tiers:
        invoices = invoices.filter(days.isin(list(params.tiers)))
    if convert == "all":
        value = (gross * rate).cast(money.CREDIT)
        capped = gross
    else:
        value = money.in_base_currency(gross, F.col("invoiceCurrencyCode"), rate)
        capped = F.col("baseValue")
    term_cost = days.cast("decimal(10,0)")
    offers = invoices.withColumn("baseValue", value).withColumns(
        {
            "grossFinance": (F.col("baseValue") * (term_cost * money.literal(cost))).cast(money.OFFER),
            "maxAllowedOffer": (capped * money.literal(cap)).cast(money.OFFER),
            "discountAmount": (
                F.col("baseValue") * (term_cost * money.literal(cost * share))
            ).cast(money.OFFER),
            "offerAvailableDate": F.date_add(available_from, early_days(days, params)),
        }
    )
    if keep == ">=":
        return offers.filter(F.col("maxAllowedOffer") >= F.col("discountAmount"))
    return offers.filter(F.col("maxAllowedOffer") > F.col("discountAmount"))


def gross_interest(invoices: DataFrame, params: CustomerParams) -> DataFrame:
    """Exploratory form that adds the daily cost to the term instead of multiplying."""
    cost = money.fraction(params.cost_of_finance_per_day)
    value = money.in_base_currency(
        F.col("invoiceGrossValue"), F.col("invoiceCurrencyCode"), money.literal(params.exchange_rate)
    )
    factor = F.col("termDays").cast("decimal(10,0)") + money.literal(cost)
    return invoices.withColumn("baseValue", value).withColumn(
        "grossInterest", (F.col("baseValue") * factor).cast(money.OFFER)
    )
