"""Money as decimals: types, currency conversion, tax and discount amounts.

Factors are cast to decimals before they are multiplied and a result is rounded
once, at the end, so that sums do not depend on the order of the rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(12,2)"
RATIO = "decimal(4,2)"
LINE_GROSS = "decimal(18,2)"
CREDIT = "decimal(20,2)"
OFFER = "decimal(20,4)"
# With an amount of a line this just fits 38 digits, so no product is rounded early. A rate of more
# than 10 places is rounded half up to 10 when it is read; the ERP's own column has fewer.
RATE = "decimal(19,10)"

# Fixed value: the one currency that is converted to the base currency.
CONVERTED_CURRENCY = "USD"


def fraction(percent: Decimal) -> Decimal:
    """Percent to a plain fraction, without trailing zeros: 40 -> 0.4."""
    return (Decimal(percent) / 100).normalize()


def literal(value: Decimal) -> Column:
    """A decimal literal in plain (not exponent) notation."""
    value = Decimal(value)
    if value == value.to_integral_value():
        value = value.quantize(Decimal(1))
    return F.lit(value)


def line_gross(price: Column, discount: Column, tax: Column) -> Column:
    net = price.cast(AMOUNT) * (F.lit(1) - discount.cast(RATIO))
    return (net * (F.lit(1) + tax.cast(RATIO))).cast(LINE_GROSS)


def in_base_currency(amount: Column, currency: Column, rate: Column) -> Column:
    """Convert one currency; all others, and a null currency, stay as they are."""
    return (
        F.when(currency == CONVERTED_CURRENCY, amount * rate).otherwise(amount).cast(CREDIT)
    )


def tax_exclusive(amount: Column, tax: Column) -> Column:
    """Amount less tax; an amount without tax (zero or null) is kept."""
    return F.when(tax != 0, amount - tax).otherwise(amount)


def distribution_flag(total: Column) -> Column:
    """N for a zero distribution total, Y for any other one and for null."""
    return F.when(total == 0, "N").otherwise("Y")


def smaller_or_second(a: Column, b: Column) -> Column:
    """``a`` where it is smaller, else ``b``; unlike ``least`` a null ``a`` gives ``b``."""
    return F.when(a < b, a).otherwise(b)


def percent_of(part: Column, whole: Column) -> Column:
    """Part as a percentage of whole to 4 places; null for a zero whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 4)
