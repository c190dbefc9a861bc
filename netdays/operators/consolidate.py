"""Lines to invoices and sites to parties: one row per key, in one shuffle each.

"First" always means: first non-null value by a stated order, so a rerun or a
lost executor gives the same answer. All aggregates keep a constant-size state
and combine before the shuffle, so a key that holds a third of the rows costs
no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(value: str, order: Sequence[str]) -> Column:
    """First non-null ``value`` of a group by the ``order`` columns.

    Rows with a null value get a null rank, which the aggregate passes over. One
    fixed-width order column keeps its state, and so the shuffle, small.
    """
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.min_by(value, F.when(F.col(value).isNotNull(), rank)).alias(value)


def consolidate_lines(
    lines: DataFrame,
    order: Sequence[str],
    key: str = "invoiceNumber",
    amount: str = "invoiceGrossValue",
    firsts: Sequence[str] = ("invoiceDate", "customerNumber", "invoiceCurrencyCode", "customerKey"),
) -> DataFrame:
    """Flat invoice lines to invoices: sum of the amount, first of the rest.

    Lines without an invoice number are dropped and an all-null sum is zero.
    """
    total = F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(20,2)").alias(amount)
    return (
        lines.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(total, *[first_by(c, order) for c in firsts])
    )


def consolidate_to_headers(
    headers: DataFrame,
    lines: DataFrame,
    key: str = "invoiceNumber",
    amount: str = "invoiceGrossValue",
) -> DataFrame:
    """Same result where the other columns live on a one-row-per-invoice header.

    Only key and amount of a line are shuffled, already summed per map task, and
    the join reuses the partitioning of that sum.
    """
    sums = (
        lines.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(20,2)").alias(amount))
    )
    return headers.join(sums, key, "inner")


def one_row_per_party(
    sites: DataFrame,
    key: str,
    firsts: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Repeated party rows to one per key, first non-null value per column."""
    return (
        sites.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[first_by(c, order) for c in firsts])
    )


def customers_by_number(sites: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per customer number, with the largest terms text."""
    firsts = ["name", "email", "phone", "customerType"]
    return (
        sites.filter(F.col("customerNumber").isNotNull())
        .groupBy("customerNumber")
        .agg(*[first_by(c, order) for c in firsts], F.max("creditTerms").alias("creditTerms"))
    )


def customers_by_key_mean_number(sites: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per customer key, with the largest terms and the mean number."""
    firsts = ["name", "email", "phone", "customerType", "location"]
    return (
        sites.filter(F.col("customerKey").isNotNull())
        .groupBy("customerKey")
        .agg(
            *[first_by(c, order) for c in firsts],
            F.max("creditTerms").alias("creditTerms"),
            F.avg("customerNumber").alias("customerNumber"),
        )
    )


def key_frequency(rows: DataFrame, key: str) -> DataFrame:
    """How often each value of a key occurs."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    return key_frequency(rows, key).filter(F.col("n") > 1)
