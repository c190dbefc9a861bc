"""Joined reports on offers and invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.sources import files

PARTY_CLASHES = {
    "createAt": "partyCreateAt", "modifiedAt": "partyModifiedAt",
    "createdBy": "partyCreatedBy", "modifiedBy": "partyModifiedBy",
}


def _renamed(party: DataFrame, offers: DataFrame, key: str) -> DataFrame:
    """Party columns that offers have too, other than the key, under their own names."""
    clash = {}
    for c in party.columns:
        if c != key and c in offers.columns:
            clash[c] = PARTY_CLASHES.get(c, "party" + c[0].upper() + c[1:])
    return party.withColumnsRenamed(clash)


def customer_offer_report(offers: DataFrame, customers: DataFrame) -> DataFrame:
    """Every offer with its customer, one customer row per key."""
    return offers.join(_renamed(customers, offers, "customerKey"), "customerKey", "left")


def supplier_offer_report(payments: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Every payment offer with its supplier."""
    return payments.join(_renamed(suppliers, payments, "supplierId"), "supplierId", "left")


def invoices_with_customer(invoices: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """Inner join on a foreign key; where names clash the invoice's column is kept."""
    extra = [c for c in customers.columns if c == key or c not in invoices.columns]
    return invoices.join(customers.select(*extra), key, "inner")


def export_by_status(report: DataFrame, path: str, file_format: str = "csv") -> None:
    """A report as files, one folder per offer status."""
    # Few files for a small status, several tasks for a large one.
    balanced = report.hint("rebalance", "offerStatus")
    if file_format == "csv":
        files.write_csv(balanced, path, ["offerStatus"])
    else:
        balanced.write.partitionBy("offerStatus").format(file_format).save(path)


def preview(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by a stated order."""
    return rows.orderBy(*[F.col(c) for c in order]).limit(n)


def column_types(rows: DataFrame) -> dict[str, str]:
    return dict(rows.dtypes)
