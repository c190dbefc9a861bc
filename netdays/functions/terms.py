"""Payment terms such as ``30 Days Net``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The phrase an eligible term holds, and the shortest useful term.
DAYS_NET = "days net"
MIN_TERM_DAYS = 7
# Fixed value: the last day that a date can be.
LAST_DAY = "9999-12-31"


def is_days_net(terms: Column) -> Column:
    """True for terms that mention "days net" in any case; null terms are false."""
    return F.coalesce(F.lower(terms).contains(DAYS_NET), F.lit(False))


def _as_days(text: Column) -> Column:
    days = text.try_cast("int")
    return F.when(days >= 0, days)


def leading_days(terms: Column) -> Column:
    """The first blank-separated word as a number of days, else null."""
    return _as_days(F.get(F.split(terms, " ", 2), 0))


def first_digits(terms: Column) -> Column:
    """The first run of digits anywhere in the text, else null."""
    return _as_days(F.nullif(F.regexp_extract(terms, r"\d+", 0), F.lit("")))


def has_due_date(day: Column, days: Column) -> Column:
    """Whether so many days after a day there is a date; true where either is null."""
    return F.coalesce(days <= F.datediff(F.lit(LAST_DAY).cast("date"), day), F.lit(True))


def without_due_date(invoices: DataFrame) -> DataFrame:
    """Invoices whose ``_days`` are unknown or lead to no date, without that column."""
    days = F.col("_days")
    return invoices.filter(days.isNull() | ~has_due_date(F.col("invoiceDate"), days)).drop("_days")


def long_enough(days: Column) -> Column:
    """Terms strictly longer than a week leave room for an early payment."""
    return days > MIN_TERM_DAYS
