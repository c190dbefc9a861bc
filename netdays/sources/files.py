"""CSV and parquet files as invoice and party sources, and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netdays.functions import keys

ISO_DATE = "yyyy-MM-dd"

# Column headers of the ERP's file exports and their canonical names.
RECEIVABLE_HEADERS = {
    "INVOICE_NUMBER": "invoiceNumber",
    "INVOICE_DATE": "invoiceDate",
    "Customer No": "customerNumber",
    "INVOICE_GROSS_VALUE": "invoiceGrossValue",
    "INVOICE_CURRENCY_CODE": "invoiceCurrencyCode",
    "SHIP_TO_LOCATIONS1": "shipTo",
}
CUSTOMER_HEADERS = {
    "Customer No": "customerNumber",
    "Customer Name": "name",
    "EMAIL_ADDRESS": "email",
    "Phone Number": "phone",
    "Customer Type": "customerType",
    "Terms": "creditTerms",
    "Location": "location",
}
PAYABLE_HEADERS = {
    "VENDOR_ID": "vendorId",
    " Invoice Number": "invoiceNumber",
    "Invoice Date": "invoiceDate",
    "Inclusive KSH": "invoiceGrossValue",
}
SUPPLIER_HEADERS = {
    "SUPPLIER ID": "vendorId",
    "SUPPLIER NAME": "supplierName",
    "SUPPLIER TYPE": "supplierType",
    "PAY TERMS": "creditTerms",
    "PHONE": "phone",
    "EMAIL_ADDRESS": "email",
}


def read_csv(
    spark: SparkSession, path: str, schema: StructType, dates: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header and a declared schema; text that is no date becomes null."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return rows.withColumns({c: F.try_to_date(F.col(c), ISO_DATE) for c in dates})


def write_csv(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV with a header; blanks around names and values are kept."""
    (
        rows.write.partitionBy(*partition_by)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def canonical(
    rows: DataFrame, headers: dict[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """The columns a header map names, under their canonical names, and some others."""
    return rows.select(*[F.col(f"`{old}`").alias(new) for old, new in headers.items()], *keep)


def receivable_lines(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """An invoice file's lines with customer key, typed like the ERP extract.

    ``keep`` names further columns, such as the one that orders the lines.
    """
    named = canonical(rows, RECEIVABLE_HEADERS, keep).withColumns(
        {
            "invoiceDate": F.col("invoiceDate").try_cast("date"),
            "customerNumber": keys.number_text(F.col("customerNumber")),
            "invoiceGrossValue": F.col("invoiceGrossValue").try_cast("decimal(18,2)"),
        }
    )
    return named.withColumn(
        "customerKey", keys.party_key(F.col("shipTo"), F.col("customerNumber"))
    ).drop("shipTo")


# What typed columns of an invoice file must be able to hold.
FILE_TYPES = {"vendorId": "bigint", "invoiceDate": "date", "invoiceGrossValue": "decimal(20,2)"}


def unreadable(rows: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rows of a file with a value that its column's type cannot hold, and the reason.

    The readers turn such a value into null rather than stop at it.
    """
    named = canonical(rows, headers)
    reason = F.coalesce(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), f"{c} not readable")
        for c, kind in FILE_TYPES.items() if c in named.columns
    ])
    return named.withColumn("rejectReason", reason).filter(F.col("rejectReason").isNotNull())


def customer_sites(rows: DataFrame) -> DataFrame:
    named = canonical(rows, CUSTOMER_HEADERS).withColumn(
        "customerNumber", keys.number_text(F.col("customerNumber"))
    )
    return named.withColumn(
        "customerKey", keys.party_key(F.col("location"), F.col("customerNumber"))
    )


def payable_invoices(rows: DataFrame) -> DataFrame:
    """A supplier invoice file, exact repeats removed."""
    named = canonical(rows, PAYABLE_HEADERS).withColumns(
        {
            "vendorId": F.col("vendorId").try_cast("bigint"),
            "invoiceDate": F.col("invoiceDate").try_cast("date"),
            "invoiceGrossValue": F.col("invoiceGrossValue").try_cast("decimal(20,2)"),
        }
    )
    return named.withColumn(
        "invoiceUniqueKey", keys.invoice_key(F.col("vendorId"), F.col("invoiceNumber"))
    ).distinct()


def supplier_rows(rows: DataFrame) -> DataFrame:
    return (
        canonical(rows, SUPPLIER_HEADERS)
        .withColumn("vendorId", F.col("vendorId").try_cast("bigint"))
        .distinct()
    )
