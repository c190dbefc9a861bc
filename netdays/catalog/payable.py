"""Payable offers, base-currency amounts and supplier master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netdays.catalog import query, sql
from netdays.functions import keys
from netdays.operators.consolidate import key_frequency, repeated_keys
from netdays.operators.incremental import watermark
from netdays.operators.lookups import membership_flag
from netdays.params import SAMPLE_SUPPLIER
from netdays.plans.payables import canonical_invoices, payable_offers
from netdays.session import new_scratch_path
from netdays.sources import files, payables, standins
from netdays.sources.ledger import Ledger
from netdays.streaming.offers import file_stream, supplier_offer_stream


@query(sql.payable_offers(SAMPLE_SUPPLIER))
def ap_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    offered = standins.offered_payables(spark, sf_dir)
    since = watermark(offered, standins.AS_OF)
    extract = standins.payable_invoices(spark, sf_dir, since, standins.AS_OF)
    return payable_offers(
        canonical_invoices(extract), standins.suppliers(spark, sf_dir), offered, SAMPLE_SUPPLIER
    )


@query(f"""
SELECT invoiceUniqueKey, invoiceDate, vendorId, invoiceNumber, supplierId, creditAmount, discountRate,
  cast(discountPercentage AS decimal(14,4)) AS discountPercentage, originalPaymentDate,
  offeredPaymentDate, 'not_sent' AS offerStatus
FROM ({sql.payable_offers(SAMPLE_SUPPLIER)})""")
def streaming_payables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as a file stream of supplier invoices, priced into a ledger."""
    offered = standins.offered_payables(spark, sf_dir)
    since = watermark(offered, standins.AS_OF)
    stored = standins.table(spark, sf_dir, "lineitem").schema
    feed = file_stream(spark, sf_dir, stored, pattern="lineitem.parquet")
    ledger = Ledger(spark, new_scratch_path(spark, "streamed-ledger"))
    supplier_offer_stream(
        standins.as_payables(feed, since, standins.AS_OF),
        standins.suppliers(spark, sf_dir),
        ledger,
        SAMPLE_SUPPLIER,
        new_scratch_path(spark, "stream-state"),
        offered_elsewhere=offered,
    ).awaitTermination()
    return ledger.read("supplierPayment").select(
        "invoiceUniqueKey", "invoiceDate", "vendorId", "invoiceNumber", "supplierId",
        "creditAmount", "discountRate", "discountPercentage", "originalPaymentDate",
        "offeredPaymentDate", "offerStatus",
    )


@query(f"""
WITH {sql.PAYABLES}
SELECT vendorId, invoiceNumber, invoiceDate, glDate, currency, tax, amount,
  CASE WHEN distributionTotal = 0 THEN 'N' ELSE 'Y' END AS distributionFlag,
  CASE WHEN tax <> 0 THEN amount - tax ELSE amount END AS exclusive,
  {sql.in_base('(amount - tax)')} AS exclusiveBase,
  {sql.in_base('tax')} AS taxBase, {sql.in_base('amount')} AS inclusiveBase
FROM payables JOIN supplier ON s_suppkey = vendorId
WHERE glDate BETWEEN DATE '1999-01-01' AND DATE '2001-12-31'""")
def ap_invoice_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice extract over a GL window, with flags and three base amounts."""
    relations = standins.payable_relations(spark, sf_dir)
    columns = (
        "vendorId", "invoiceNumber", "invoiceDate", "glDate", "currency", "tax", "amount",
        "distributionFlag", "exclusive", "exclusiveBase", "taxBase", "inclusiveBase",
    )
    return payables.invoice_extract(
        relations, standins.GL_FROM, standins.AS_OF, org_id=82, columns=columns
    )


@query(f"""
WITH {sql.PAYABLES}
SELECT p.vendorId, p.invoiceNumber, p.invoiceDate, n_name AS createdBy, p.amount,
  CASE WHEN o_orderstatus = 'P' THEN 'Yes' ELSE 'No' END AS attachments
FROM payables p JOIN supplier ON s_suppkey = vendorId
LEFT JOIN nation ON n_nationkey = cast(split_part(invoiceNumber, '-', 2) AS integer)
LEFT JOIN orders ON o_orderkey = cast(split_part(invoiceNumber, '-', 1) AS bigint)
WHERE glDate BETWEEN DATE '1999-01-01' AND DATE '2001-12-31'""")
def ap_invoice_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice extract with creator and attachment flag."""
    relations = standins.payable_relations(spark, sf_dir)
    columns = ("vendorId", "invoiceNumber", "invoiceDate", "createdBy", "amount", "attachments")
    return payables.invoice_extract(
        relations, standins.GL_FROM, standins.AS_OF, org_id=82, columns=columns
    )


@query(f"""
WITH {sql.PAYABLES},
copies AS (SELECT * FROM payables UNION ALL SELECT * FROM payables WHERE l_returnflag = 'R')
SELECT DISTINCT invoiceUniqueKey, invoiceDate, vendorId, invoiceNumber,
  {sql.in_base('amount')} AS invoiceGrossValue FROM copies""")
def ap_invoice_base_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical invoices of a feed that repeats a third of its rows."""
    extract = standins.payable_invoices(spark, sf_dir)
    copies = extract.unionByName(extract.filter(F.col("returnFlag") == "R"))
    return canonical_invoices(copies)


@query(f"""
WITH {sql.PAYABLES}
SELECT DISTINCT invoiceUniqueKey, vendorId, invoiceNumber, invoiceDate,
  cast(amount AS decimal(20,2)) AS invoiceGrossValue FROM payables""")
def ap_invoice_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier invoices exported as CSV under the ERP's headers, with repeats, and read."""
    extract = standins.payable_invoices(spark, sf_dir).withColumnRenamed("amount", "invoiceGrossValue")
    names = [F.col(new).alias(old) for old, new in files.PAYABLE_HEADERS.items()]
    copies = extract.unionByName(extract.filter(F.col("returnFlag") == "R")).select(*names)
    path = new_scratch_path(spark, "payable-file")
    files.write_csv(copies, path)
    schema = ", ".join(f"`{c}` string" for c in files.PAYABLE_HEADERS)
    stored = files.read_csv(spark, path, StructType.fromDDL(schema))
    return files.payable_invoices(stored)


@query(f"""
WITH {sql.PAYABLES}
SELECT invoiceUniqueKey, vendorId, invoiceNumber, invoiceDate,
  CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderkey = cast(split_part(invoiceNumber, '-', 1) AS bigint)
                    AND o_orderstatus = 'P') THEN 'Yes' ELSE 'No' END AS attachments
FROM payables""")
def attachment_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices that have an attached document: those of pending orders."""
    invoices = standins.payable_invoices(spark, sf_dir).select(
        "vendorId", "invoiceNumber", "invoiceDate",
        F.split_part("invoiceNumber", F.lit("-"), F.lit(1)).cast("bigint").alias("documentKey"),
    )
    attached = (
        standins.table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.col("o_orderkey").alias("documentKey"))
    )
    flagged = membership_flag(
        invoices, attached, "documentKey", "attachments", spread_by=["vendorId", "invoiceNumber"]
    )
    return flagged.drop("documentKey").withColumn(
        "invoiceUniqueKey", keys.invoice_key(F.col("vendorId"), F.col("invoiceNumber"))
    )


@query(f"""
SELECT l_orderkey, l_linenumber, l_suppkey, {sql.AP_KEY} AS invoiceUniqueKey FROM lineitem""")
def invoice_key_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
    )
    return standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        keys.invoice_key(F.col("l_suppkey"), number).alias("invoiceUniqueKey"),
    )


@query(f"""
SELECT {sql.AP_KEY} AS invoiceUniqueKey, count(*) AS n FROM lineitem GROUP BY 1""")
def invoice_key_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_frequency(invoice_key_composite(spark, sf_dir), "invoiceUniqueKey")


@query(f"""
SELECT {sql.AP_KEY} AS invoiceUniqueKey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def duplicate_invoice_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(invoice_key_composite(spark, sf_dir), "invoiceUniqueKey")


# The supplier master check repeats the stand-in relations in SQL: two sites and
# two contacts per supplier, accounts out of the parts a supplier delivers.
SUPPLIER_SQL = f"""
WITH sites AS (
  SELECT s_suppkey AS vendor_id, s_suppkey * 2 + k AS site_id
  FROM supplier CROSS JOIN (VALUES (0), (1)) AS v(k) WHERE s_suppkey % 5 <> 4 AND (k = 0 OR s_suppkey % 2 = 0)
),
contacts AS (
  SELECT s_suppkey AS vendor_id, k, 'c' || s_suppkey || '.' || k || '@example.com' AS email,
    '555-' || s_suppkey || '-' || k AS phone,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Q' END AS middle
  FROM supplier CROSS JOIN (VALUES (0), (1)) AS v(k) WHERE s_suppkey % 4 <> 3
),
accounts AS (
  SELECT l_suppkey AS party_id, p_partkey AS account_id, p_brand AS bank, p_type AS branch, p_name
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey
),
full_match AS (
  SELECT party_id, min(account_id) AS account_id FROM accounts WHERE bank <> 'Brand#1' GROUP BY party_id
),
any_match AS (SELECT party_id, min(account_id) AS account_id FROM accounts GROUP BY party_id)
SELECT s.s_suppkey AS vendorId, s.s_name AS supplierName,
  CASE WHEN s.s_suppkey % 7 = 1 THEN NULL ELSE 'VENDOR' END AS supplierType,
  {sql.SUPPLIER_TERMS} AS creditTerms, st.site_id AS vendorSiteId,
  c.email, c.phone,
  'Mr ' || 'F' || ' ' || coalesce(c.middle, '') || ' ' || 'L' AS contactName0,
  CASE WHEN s.s_suppkey % 3 = 0 THEN 'Yes' WHEN s.s_suppkey % 3 = 1 THEN 'No' ELSE 'X' END AS autoCalculateTaxFlag,
  CASE WHEN coalesce(CASE s.s_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END, 'N') <> 'Y' THEN '2-Way'
       WHEN coalesce(CASE s.s_suppkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END, 'N') = 'Y' THEN '4-Way'
       ELSE '3-Way' END AS matchingLevel,
  CASE WHEN st.site_id IS NOT NULL THEN fa.bank END AS bankName,
  CASE WHEN st.site_id IS NOT NULL THEN fa.branch END AS bankBranchName,
  CASE WHEN st.site_id IS NOT NULL THEN 'ACC' || am.account_id END AS bankAccountNumber,
  CASE WHEN st.site_id IS NOT NULL THEN aa.p_name END AS bankAccountName
FROM supplier s
LEFT JOIN sites st ON st.vendor_id = s.s_suppkey
LEFT JOIN contacts c ON c.vendor_id = st.vendor_id
LEFT JOIN full_match fm ON fm.party_id = s.s_suppkey
LEFT JOIN accounts fa ON fa.party_id = fm.party_id AND fa.account_id = fm.account_id
LEFT JOIN any_match am ON am.party_id = s.s_suppkey
LEFT JOIN accounts aa ON aa.party_id = am.party_id AND aa.account_id = am.account_id
WHERE CASE WHEN s.s_suppkey % 7 = 0 THEN 'EMPLOYEE' WHEN s.s_suppkey % 7 = 1 THEN NULL ELSE 'VENDOR' END <> 'EMPLOYEE'
"""


@query(f"""
SELECT vendorId, supplierName, supplierType, creditTerms, vendorSiteId, email, phone,
  CASE WHEN phone IS NULL THEN '   ' ELSE contactName0 END AS contactName,
  autoCalculateTaxFlag, matchingLevel, bankName, bankBranchName, bankAccountNumber, bankAccountName
FROM ({SUPPLIER_SQL})""")
def ap_supplier_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole supplier extract: sites, contacts, terms, first bank and account."""
    extract = payables.supplier_extract(standins.supplier_relations(spark, sf_dir))
    return extract.select(
        "vendorId", "supplierName", "supplierType", "creditTerms", "vendorSiteId", "email",
        "phone", "contactName", "autoCalculateTaxFlag", "matchingLevel",
        "bankName", "bankBranchName", "bankAccountNumber", "bankAccountName",
    )


@query(f"""
SELECT vendorId, min(supplierName) AS supplierName, min(supplierType) AS supplierType,
  min(creditTerms) AS creditTerms, min(phone) AS phone, min(email) AS email
FROM ({SUPPLIER_SQL}) GROUP BY vendorId""")
def ap_supplier_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical suppliers, one row per vendor."""
    return payables.supplier_parties(standins.supplier_relations(spark, sf_dir))


@query(f"""
SELECT DISTINCT vendorId, supplierName, supplierType, creditTerms, phone, email FROM ({SUPPLIER_SQL})""")
def ap_supplier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical supplier rows, exact repeats removed."""
    extract = payables.supplier_extract(standins.supplier_relations(spark, sf_dir))
    return payables.supplier_rows(extract).orderBy("vendorId")
