"""High-watermark, what is new, and completing the parties."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.functions.dates import lookback_start


def watermark_table(offers: DataFrame, as_of: dt.date, column: str = "invoiceDate") -> DataFrame:
    """One row: the last offered invoice date, else two months before ``as_of``."""
    last = F.max(F.col(column).cast("date"))
    return offers.agg(F.coalesce(last, lookback_start(F.lit(as_of))).alias("watermark"))


def watermark(offers: DataFrame, as_of: dt.date, column: str = "invoiceDate") -> dt.date:
    """The watermark as a value, so that the filters made of it push down."""
    return watermark_table(offers, as_of, column).head()[0]


def not_yet_offered(invoices: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """Invoices whose key is in no offer. The type of the invoice key wins.

    An anti join keeps null keys and needs no distinct on the ledger side.
    """
    key_type = invoices.schema[key].dataType
    return invoices.join(offered.select(F.col(key).try_cast(key_type).alias(key)), key, "left_anti")


def offered_among(invoices: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """Ledger keys that occur among the invoices.

    With invoices that were written before, and so have a known size, a small
    load is broadcast to where the ledger is read: the whole ledger's keys are
    then scanned but not shuffled for the anti join that follows.
    """
    key_type = invoices.schema[key].dataType
    keys = offered.select(F.col(key).try_cast(key_type).alias(key))
    return only_keys(keys, invoices.select(key), key)


def missing_parties(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct incoming keys that are not known yet."""
    keys = incoming.filter(F.col(key).isNotNull()).select(key).distinct()
    return not_yet_offered(keys, known, key)


def only_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys``; the key list may hold nulls and repeats."""
    key_type = rows.schema[key].dataType
    return rows.join(keys.select(F.col(key).try_cast(key_type).alias(key)), key, "left_semi")


def complete_parties(known: DataFrame, fetched: DataFrame) -> DataFrame:
    """Known parties and newly fetched ones; columns only one side has become null."""
    return known.unionByName(fetched, allowMissingColumns=True)
