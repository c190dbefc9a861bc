"""Customer master, keys, terms and roll-ups of parties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.catalog import query, sql
from netdays.functions import keys, terms
from netdays.operators.consolidate import customers_by_key_mean_number, customers_by_number
from netdays.sources import receivables, standins
from netdays.sources.relations import Relations, staged_relations

_SITE_ORDER = ["siteUseNumber"]


def _relations(spark: SparkSession, sf_dir: str) -> Relations:
    """The customer master as an extract finds it after staging."""
    return staged_relations(standins.customer_relations(spark, sf_dir), [*receivables.STAGED, "hz_parties"])


# One row per active use of an active customer, by formula from the tables.
SITE_SQL = f"""
SELECT c_custkey AS customerNumber, c_name AS name, c_mktsegment AS customerClass,
  CASE c_custkey % 3 WHEN 0 THEN 'External' WHEN 1 THEN 'Internal' ELSE 'X' END AS accountType,
  strftime(DATE '2014-01-01' + cast(c_custkey % 3650 AS integer), '%d-%m-%Y') AS creationDate,
  'ORGANIZATION' AS customerType,
  cast((c_custkey * 10 + d) * 2 + k AS varchar) AS siteUseId,
  ' ' || n_name || '-' || p AS location,
  CASE k WHEN 0 THEN 'Bill To ' ELSE 'Ship To ' END AS siteUse,
  {sql.terms_case('(c_custkey + k)', standins.CUSTOMER_TERMS)} AS creditTerms,
  cast(c_custkey * 100 AS decimal(20,2)) AS kesCreditLimit,
  cast(c_custkey AS decimal(20,2)) AS usdCreditLimit,
  CASE c_custkey % 2 WHEN 0 THEN 'Yes' ELSE 'No' END AS creditCheck,
  'COL ' || n_name AS collector, 'REP ' || n_name AS defaultSalesPerson,
  'RES ' || n_name AS salesPerson, 'CLASS ' || n_name AS profileClass,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) THEN 'BANK NATION_' || (acc % 25) END AS bankName,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) THEN 'ACC' || acc END AS bankAccountNumber,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) THEN 'BRANCH NATION_' || (acc % 25) END AS bankBranchName,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) AND d <> 5 AND c_custkey % 6 <> 5 AND c_custkey % 4 <> 3 THEN
    'First' || c_custkey || ' ' || CASE WHEN c_custkey % 3 <> 0 THEN 'Last0' ELSE '' END END AS contactPerson,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) AND d <> 5 AND c_custkey % 6 <> 5 AND c_custkey % 4 <> 3 THEN 'Job0' END AS jobTitle,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) AND d <> 5 AND c_custkey % 6 <> 5 THEN
    '254-' || CASE WHEN c_custkey % 2 = 0 THEN '20' ELSE '' END || '-' || c_custkey || '/0' END AS phone,
  CASE WHEN NOT (d = 3 AND c_custkey % 5 = 1) AND d <> 5 AND c_custkey % 6 <> 5 THEN 'p' || c_custkey || '@example.com' END AS contactEmail,
  CASE WHEN c_custkey % 10 <> 0 THEN 'ar' || c_custkey || '@example.com' END AS email,
  {sql.normalized("' ' || n_name || '-' || p")} || '_' || c_custkey AS customerKey
FROM (SELECT o_custkey AS c, o_orderpriority AS p, cast(substr(o_orderpriority, 1, 1) AS bigint) AS d,
             min(o_orderkey) AS acc FROM orders GROUP BY 1, 2, 3)
JOIN customer ON c_custkey = c JOIN nation ON n_nationkey = c_nationkey
CROSS JOIN (VALUES (0), (1)) AS v(k)
WHERE c_custkey % 13 <> 0 AND (c_custkey + d) % 11 <> 0"""

_SITE_COLUMNS = (
    "customerNumber", "name", "customerClass", "accountType", "creationDate", "customerType",
    "siteUseId", "location", "siteUse", "creditTerms", "kesCreditLimit", "usdCreditLimit",
    "creditCheck", "collector", "defaultSalesPerson", "salesPerson",
    "profileClass", "bankName", "bankAccountNumber", "bankBranchName", "contactPerson",
    "jobTitle", "phone", "contactEmail", "email", "customerKey",
)


@query(SITE_SQL)
def ar_customer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer site extract with all its look-ups."""
    relations = _relations(spark, sf_dir)
    return _with_number(receivables.customer_extract(relations, columns=_SITE_COLUMNS))


@query(f"""
SELECT customerKey, min(customerNumber) AS customerNumber, min(name) AS name, min(email) AS email,
  min(phone) AS phone, min(customerType) AS customerType,
  arg_min(creditTerms, cast(siteUseId AS bigint)) AS creditTerms, min(location) AS location
FROM ({SITE_SQL}) GROUP BY customerKey""")
def ar_customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer key; the uses of a site differ in their terms only."""
    relations = _relations(spark, sf_dir)
    return _with_number(receivables.customer_master(relations))


@query(f"""
SELECT customerNumber, min(name) AS name, min(email) AS email, arg_min(phone, siteUseId) AS phone,
  min(customerType) AS customerType, max(creditTerms) AS creditTerms
FROM (SELECT * REPLACE (cast(siteUseId AS bigint) AS siteUseId) FROM ({SITE_SQL}))
GROUP BY customerNumber""")
def customer_rollup_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per number, with the largest terms."""
    return customers_by_number(_numbered_sites(spark, sf_dir), _SITE_ORDER)


@query(f"""
SELECT customerKey, min(name) AS name, min(email) AS email, arg_min(phone, siteUseId) AS phone,
  min(customerType) AS customerType, min(location) AS location,
  max(creditTerms) AS creditTerms, avg(customerNumber) AS customerNumber
FROM (SELECT * REPLACE (cast(siteUseId AS bigint) AS siteUseId) FROM ({SITE_SQL}))
GROUP BY customerKey""")
def customer_rollup_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key, with the largest terms and the mean number."""
    return customers_by_key_mean_number(_numbered_sites(spark, sf_dir), _SITE_ORDER)


def _numbered_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*receivables.CUSTOMER_COLUMNS, "siteUseId"]
    relations = _relations(spark, sf_dir)
    rows = receivables.customer_rows(relations, columns=columns)
    return _with_number(rows).withColumn("siteUseNumber", F.col("siteUseId").cast("bigint"))


def _with_number(rows: DataFrame) -> DataFrame:
    return rows.withColumn("customerNumber", F.col("customerNumber").cast("bigint"))


@query(f"""
SELECT c_custkey, {sql.SITE} AS site, {sql.normalized(sql.SITE)} AS normalized, {sql.PARTY_KEY} AS customerKey
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def party_key_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = standins.site_text()
    return standins.customers_with_nation(spark, sf_dir).select(
        "c_custkey",
        site.alias("site"),
        keys.normalize_text(site).alias("normalized"),
        keys.party_key(site, F.col("c_custkey")).alias("customerKey"),
    )


_BOTH_TERMS = (
    "SELECT c_custkey AS partyKey, 'AR' AS side, " + sql.CUSTOMER_TERMS + " AS terms FROM customer"
    " UNION ALL SELECT s_suppkey, 'AP', " + sql.SUPPLIER_TERMS + " FROM supplier"
)


@query(f"""
SELECT partyKey, side, terms, coalesce(lower(terms) LIKE '%days net%', FALSE) AS isDaysNet,
  try_cast(split_part(terms, ' ', 1) AS integer) AS leadingDays,
  try_cast(nullif(regexp_extract(terms, '\\d+'), '') AS integer) AS firstDigits,
  coalesce(lower(terms) LIKE '%days net%', FALSE)
    AND coalesce(try_cast(nullif(regexp_extract(terms, '\\d+'), '') AS integer) > 7, FALSE) AS eligible
FROM ({_BOTH_TERMS})""")
def terms_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict and lenient reading of the terms of all parties, side by side."""
    customers = standins.customers(spark, sf_dir).select(
        F.col("customerId").alias("partyKey"), F.lit("AR").alias("side"), F.col("creditTerms").alias("terms")
    )
    suppliers = standins.suppliers(spark, sf_dir).select(
        F.col("vendorId").alias("partyKey"), F.lit("AP").alias("side"), F.col("creditTerms").alias("terms")
    )
    text = F.col("terms")
    lenient = terms.first_digits(text)
    return customers.unionByName(suppliers).select(
        "partyKey", "side", "terms",
        terms.is_days_net(text).alias("isDaysNet"),
        terms.leading_days(text).alias("leadingDays"),
        lenient.alias("firstDigits"),
        (terms.is_days_net(text) & F.coalesce(terms.long_enough(lenient), F.lit(False))).alias(
            "eligible"
        ),
    )
