"""Fixed schemas: the four ledger tables, canonical invoices and the CSV inputs."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LONG, INT, TEXT, DAY, MOMENT = LongType(), IntegerType(), StringType(), DateType(), TimestampType()
CREDIT, OFFER, PERCENT = DecimalType(20, 2), DecimalType(20, 4), DecimalType(14, 4)

NOT_SENT = "not_sent"


def _table(*columns: tuple) -> StructType:
    """Columns as (name, type) or, where null is allowed, (name, type, True)."""
    return StructType([StructField(c[0], c[1], len(c) == 3) for c in columns])


_AUDIT = (
    ("createAt", MOMENT, True),
    ("modifiedAt", MOMENT, True),
    ("createdBy", TEXT, True),
    ("modifiedBy", TEXT, True),
)
_SENDING = (
    ("offerSentBy", TEXT, True),
    ("offerSentDate", MOMENT, True),
    ("offerDecisionDate", MOMENT, True),
)

CUSTOMERS = _table(
    ("customerId", LONG),
    ("customerNumber", LONG, True),
    ("customerKey", TEXT),
    ("name", TEXT, True),
    ("email", TEXT, True),
    ("phone", TEXT, True),
    ("customerType", TEXT, True),
    ("creditTerms", TEXT),
    *_AUDIT,
)

CUSTOMER_OFFERS = _table(
    ("customerOfferId", LONG),
    ("invoiceDate", DAY),
    ("invoiceNumber", TEXT, True),
    ("customerId", LONG),
    ("customerKey", TEXT),
    ("creditAmount", CREDIT, True),
    ("discountRate", OFFER),
    ("discountPercentage", PERCENT),
    ("originalPaymentDate", DAY),
    ("offeredPaymentDate", DAY),
    ("totalInterest", OFFER),
    ("offerStatus", TEXT),
    *_SENDING,
    *_AUDIT,
)

SUPPLIERS = _table(
    ("supplierId", LONG),
    ("vendorId", LONG),
    ("name", TEXT, True),
    ("email", TEXT, True),
    ("phone", TEXT, True),
    ("supplierType", TEXT, True),
    ("creditTerms", TEXT, True),
    *_AUDIT,
)

SUPPLIER_PAYMENTS = _table(
    ("supplierPaymentId", LONG),
    ("invoiceUniqueKey", TEXT),
    ("invoiceDate", DAY),
    ("glDate", DAY, True),
    ("vendorId", LONG, True),
    ("invoiceNumber", TEXT, True),
    ("supplierId", LONG),
    ("creditAmount", CREDIT, True),
    ("discountRate", OFFER),
    ("discountPercentage", PERCENT),
    ("originalPaymentDate", DAY),
    ("offeredPaymentDate", DAY),
    ("offerStatus", TEXT),
    *_SENDING,
    *_AUDIT,
)

# Longest text a ledger column may hold.
FIELD_LENGTHS = {
    "customers": {"name": 255, "email": 255, "phone": 50, "customerType": 100},
    "suppliers": {"name": 255, "email": 255, "phone": 50, "supplierType": 100},
    "customerOffers": {"invoiceNumber": 50, "offerSentBy": 100},
    "supplierPayment": {"invoiceNumber": 50, "offerSentBy": 100},
}

# CSV inputs: dates arrive as text and are parsed after the read.
CUSTOMER_MASTER_CSV = StructType(
    [
        StructField("Customer_No", LONG),
        StructField("Customer_Name", TEXT),
        StructField("Terms", TEXT),
        StructField("email", TEXT),
        StructField("Entered_date", TEXT),
    ]
)
CUSTOMER_INVOICE_CSV = StructType(
    [
        StructField("invoice_id", LONG),
        StructField("invoice_date", TEXT),
        StructField("invoice_gross_value", DecimalType(18, 2)),
        StructField("invoice_currency", TEXT),
        StructField("customer_name", TEXT),
        StructField("credit_terms", TEXT),
        StructField("email", TEXT),
    ]
)


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
