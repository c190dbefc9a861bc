"""Parts of the extracts that the plain stand-ins leave constant or null, and file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netdays.catalog import query, sql
from netdays.catalog.parties import SITE_SQL
from netdays.catalog.payable import SUPPLIER_SQL, ap_offers
from netdays.functions import money
from netdays.operators.consolidate import consolidate_lines
from netdays.params import SAMPLE_SUPPLIER
from netdays.plans import reports
from netdays.session import new_scratch_path
from netdays.sources import files, payables, receivables, standins
from netdays.sources.relations import Relations, staged_relations


def _changed(relations: Relations, **frames: DataFrame) -> Relations:
    return lambda name: frames[name] if name in frames else relations(name)


@query(f"""
WITH {sql.PAYABLES}
SELECT vendorId, invoiceNumber, amount,
  CASE WHEN cast(split_part(invoiceNumber, '-', 2) AS integer) % 3 = 0 THEN 'N' ELSE 'Y' END AS distributionFlag
FROM payables JOIN supplier ON s_suppkey = vendorId
WHERE glDate BETWEEN DATE '1999-01-01' AND DATE '2001-12-31' AND cast(split_part(invoiceNumber, '-', 1) AS bigint) % 7 NOT IN (0, 3)""")
def ap_invoice_org_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices of one operating unit among three; every third one has no distribution."""
    plain = standins.payable_relations(spark, sf_dir)
    order = F.col("invoice_id") % 7
    line = F.split_part("invoice_num", F.lit("-"), F.lit(2)).cast("int")
    invoices = plain("ap_invoices_v").withColumns({
        "org_id": F.when(order == 0, 81).when(order == 3, None).otherwise(82),
        "distribution_total": F.when(line % 3 == 0, 0.0).otherwise(F.col("distribution_total")),
    })
    return payables.invoice_extract(
        _changed(plain, ap_invoices_v=invoices), standins.GL_FROM, standins.AS_OF, org_id=82,
        columns=("vendorId", "invoiceNumber", "amount", "distributionFlag"),
    )


@query(f"""
SELECT vendorId, vendorSiteId, email, bankName, 'N' || length(bankBranchName) || '-' || bankName AS branchNumber,
  CASE WHEN length(bankBranchName) % 2 = 0 THEN 'SW' || bankBranchName END AS swiftCode
FROM ({SUPPLIER_SQL})""")
def ap_supplier_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branch number and SWIFT code of the bank that a supplier's first complete account is at."""
    plain = standins.supplier_relations(spark, sf_dir)
    branch = F.col("bank_branch_name")
    branches = plain("iby_ext_bank_branches_v").withColumns({
        "branch_number": F.concat(F.lit("N"), F.length(branch), F.lit("-"), "bank_party_id"),
        "eft_swift_code": F.when(F.length(branch) % 2 == 0, F.concat(F.lit("SW"), branch)),
    })
    extract = payables.supplier_extract(_changed(plain, iby_ext_bank_branches_v=branches))
    return extract.select("vendorId", "vendorSiteId", "email", "bankName", "branchNumber", "swiftCode")


@query(f"""
WITH flat AS (
  SELECT o_orderkey, {sql.LINE_GROSS} AS gross,
    cast(o_orderdate AS date) + l_linenumber % 3 AS day,
    CASE WHEN l_linenumber > 1 THEN cast(o_custkey + l_linenumber AS varchar) END AS number,
    CASE WHEN l_linenumber % 2 = 0 THEN 'C' || l_linenumber END AS currency,
    CASE WHEN l_linenumber <> 2 THEN 'k' || l_suppkey END AS party,
    l_linenumber * 1000000000000000000 + l_partkey * 10000000 + l_suppkey % 10000000 AS ord
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)
SELECT o_orderkey AS invoiceNumber, cast(sum(gross) AS decimal(20,2)) AS invoiceGrossValue,
  arg_min(day, ord) AS invoiceDate, arg_min(number, ord) AS customerNumber,
  arg_min(currency, ord) AS invoiceCurrencyCode, arg_min(party, ord) AS customerKey
FROM flat GROUP BY o_orderkey""")
def ar_consolidate_first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose header columns differ: the first value by line that is there counts, column by column."""
    line = F.col("l_linenumber")
    headers = standins.invoice_headers(spark, sf_dir)
    lines = standins.table(spark, sf_dir, "lineitem").withColumns({
        "invoiceNumber": F.col("l_orderkey"),
        "lineId": line * F.lit(10**18) + F.col("l_partkey") * 10**7 + F.col("l_suppkey") % 10**7,
        "invoiceGrossValue": money.line_gross(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")),
    })
    varied = lines.join(headers, "invoiceNumber").withColumns({
        "invoiceDate": F.date_add("invoiceDate", line % 3),
        "customerNumber": F.when(line > 1, (F.col("customerNumber") + line).cast("string")),
        "invoiceCurrencyCode": F.when(line % 2 == 0, F.concat(F.lit("C"), line)),
        "customerKey": F.when(line != 2, F.concat(F.lit("k"), "l_suppkey")),
    })
    return consolidate_lines(varied, ["lineId"])


@query(f"""
SELECT siteUseId, cast(siteUseId AS bigint) % 25 AS priceListId, p.n_name AS priceList,
  cast(siteUseId AS bigint) % 30 AS orderTypeId, t.n_name AS orderType
FROM ({SITE_SQL}) LEFT JOIN nation p ON p.n_nationkey = cast(siteUseId AS bigint) % 25
LEFT JOIN nation t ON t.n_nationkey = cast(siteUseId AS bigint) % 30""")
def ar_customer_price_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price list and order type of each site use; some order types are not listed."""
    plain = standins.customer_relations(spark, sf_dir)
    uses = plain("hz_cust_site_uses_all").withColumns(
        {"price_list_id": F.col("site_use_id") % 25, "order_type_id": F.col("site_use_id") % 30}
    )
    relations = staged_relations(_changed(plain, hz_cust_site_uses_all=uses), receivables.STAGED)
    return receivables.customer_extract(
        relations, columns=("siteUseId", "priceListId", "priceList", "orderTypeId", "orderType")
    )


def _through_csv(rows: DataFrame, headers: dict[str, str], label: str) -> DataFrame:
    """Rows written as a file under its headers and read as text."""
    path = new_scratch_path(rows.sparkSession, label)
    files.write_csv(rows.select(*[F.col(new).alias(old) for old, new in headers.items()]), path)
    schema = StructType.fromDDL(", ".join(f"`{c}` string" for c in headers))
    return files.read_csv(rows.sparkSession, path, schema)


@query(f"""
WITH {sql.CUSTOMERS}
SELECT cast(c_custkey AS varchar) AS customerNumber, c_name AS name, 'ar' || c_custkey || '@example.com' AS email,
  '254-' || c_custkey AS phone, 'ORGANIZATION' AS customerType, creditTerms,
  ' ' || n_name || '-' || c_mktsegment AS location, customerKey
FROM parties JOIN customer USING (c_custkey, c_name, c_mktsegment) JOIN nation ON n_nationkey = c_nationkey""")
def customer_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer master as a file: numbers as text, keys from number and location."""
    site = standins.ship_to(spark, sf_dir).withColumnRenamed("shipTo", "location")
    rows = standins.customers(spark, sf_dir).join(site, "customerNumber").withColumn(
        "phone", F.concat(F.lit("254-"), "customerNumber")
    )
    return files.customer_sites(_through_csv(rows, files.CUSTOMER_HEADERS, "customer-file"))


_STATED_VENDOR = "CASE WHEN s_suppkey % 10 = 3 THEN 'V' || s_suppkey ELSE cast(s_suppkey AS varchar) END"


def _supplier_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, each third one twice, of which a tenth states a number that is none."""
    rows = standins.suppliers(spark, sf_dir).withColumnRenamed("name", "supplierName").withColumns({
        "phone": F.concat(F.lit("555-"), "vendorId"),
        "vendorId": F.when(F.col("supplierId") % 10 == 3, F.concat(F.lit("V"), "supplierId")).otherwise(
            F.col("vendorId").cast("string")
        ),
    })
    return _through_csv(rows.unionByName(rows.where("supplierId % 3 = 0")), files.SUPPLIER_HEADERS, "supplier-file")


@query(f"""
SELECT try_cast({_STATED_VENDOR} AS bigint) AS vendorId, s_name AS supplierName,
  CASE WHEN s_suppkey % 7 = 0 THEN 'EMPLOYEE' WHEN s_suppkey % 7 = 1 THEN NULL ELSE 'VENDOR' END AS supplierType,
  {sql.SUPPLIER_TERMS} AS creditTerms, '555-' || s_suppkey AS phone, 'ap' || s_suppkey || '@example.com' AS email
FROM supplier""")
def supplier_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier file, exact repeats removed; a number that is none is null."""
    return files.supplier_rows(_supplier_file(spark, sf_dir))


@query(f"""
WITH {sql.PAYABLES},
stated AS (
  SELECT invoiceNumber, cast(split_part(invoiceNumber, '-', 1) AS bigint) AS n FROM payables
)
SELECT 'payables' AS source, invoiceNumber AS rowKey,
  CASE n % 9 WHEN 1 THEN 'vendorId' WHEN 2 THEN 'invoiceDate' ELSE 'invoiceGrossValue' END || ' not readable' AS rejectReason
FROM stated WHERE n % 9 IN (1, 2, 3)
UNION ALL
SELECT 'suppliers', {_STATED_VENDOR}, 'vendorId not readable' FROM supplier
CROSS JOIN (VALUES (0), (1)) AS v(k) WHERE s_suppkey % 10 = 3 AND (k = 0 OR s_suppkey % 3 = 0)""")
def file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of invoice and supplier files with a value that its column cannot hold, and why."""
    number = F.split_part("invoiceNumber", F.lit("-"), F.lit(1)).cast("bigint") % 9
    rows = standins.payable_invoices(spark, sf_dir).withColumnRenamed("amount", "invoiceGrossValue").withColumns({
        "vendorId": F.when(number == 1, "V?").otherwise(F.col("vendorId").cast("string")),
        "invoiceDate": F.when(number == 2, "2000-13-45").otherwise(F.col("invoiceDate").cast("string")),
        "invoiceGrossValue": F.when(number == 3, "12,5").otherwise(F.col("invoiceGrossValue").cast("string")),
    })
    invoices = files.unreadable(_through_csv(rows, files.PAYABLE_HEADERS, "payable-file"), files.PAYABLE_HEADERS)
    suppliers = files.unreadable(_supplier_file(spark, sf_dir), files.SUPPLIER_HEADERS)
    return invoices.select(F.lit("payables").alias("source"), F.col("invoiceNumber").alias("rowKey"), "rejectReason").unionByName(
        suppliers.select(F.lit("suppliers").alias("source"), F.col("vendorId").alias("rowKey"), "rejectReason")
    )


@query(f"""
SELECT invoiceUniqueKey, name, creditAmount, discountRate,
  CASE s_suppkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE 'not_sent' END AS offerStatus
FROM (SELECT o.*, s_name AS name, s_suppkey FROM ({sql.payable_offers(SAMPLE_SUPPLIER)}) o LEFT JOIN supplier ON s_suppkey = o.supplierId)""")
def supplier_report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier report exported as parquet by status and read back."""
    party = F.col("supplierId") % 3
    offers = ap_offers(spark, sf_dir).select(
        "invoiceUniqueKey", "supplierId", "creditAmount", "discountRate",
        F.when(party == 0, "accepted").when(party == 1, "rejected").otherwise("not_sent").alias("offerStatus"),
    )
    report = reports.supplier_offer_report(offers, standins.suppliers(spark, sf_dir))
    path = new_scratch_path(spark, "report")
    columns = ["invoiceUniqueKey", "name", "creditAmount", "discountRate", "offerStatus"]
    reports.export_by_status(report.select(*columns), path, "parquet")
    schema = "invoiceUniqueKey string, name string, creditAmount decimal(20,2), discountRate decimal(20,4), offerStatus string"
    return spark.read.schema(schema).parquet(path)
