"""Profiles, rejects, orphans and stage counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.catalog import query, sql
from netdays.functions import terms
from netdays.operators import quality
from netdays.sources import standins


@query(f"""
WITH {sql.CUSTOMERS}
SELECT count(*) - count(c_custkey) AS customerNumber, count(*) - count(customerKey) AS customerKey,
  count(*) - count(c_name) AS name, count(*) - count(creditTerms) AS creditTerms FROM parties""")
def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.customers(spark, sf_dir)
    return quality.null_counts(rows, ["customerNumber", "customerKey", "name", "creditTerms"])


_LIMITS = {"name": 18, "creditTerms": 10, "customerKey": 20}


@query(f"""
WITH {sql.CUSTOMERS},
checked AS (
  SELECT c_custkey AS customerNumber, 'name' AS field, length(c_name) AS length, 18 AS allowed FROM parties
  UNION ALL SELECT c_custkey, 'creditTerms', length(creditTerms), 10 FROM parties
  UNION ALL SELECT c_custkey, 'customerKey', length(customerKey), 20 FROM parties
)
SELECT * FROM checked WHERE length > allowed""")
def profile_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts above a limit; the limits are tighter than the ledger's, to find some."""
    return quality.too_long(standins.customers(spark, sf_dir), _LIMITS, "customerNumber")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order is not among the settled ones."""
    lines = standins.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    settled = standins.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return quality.orphans(lines, settled, "l_orderkey", "o_orderkey")


@query(f"""
WITH {sql.CUSTOMERS},
marked AS (
  SELECT c_custkey AS customerNumber, creditTerms,
    nullif(concat_ws(',', CASE WHEN creditTerms IS NULL THEN 'creditTerms missing' END,
      CASE WHEN NOT coalesce(c_custkey % 10 <> 0, FALSE) THEN 'email missing' END), '') AS "rejectReason"
  FROM parties
)
SELECT * FROM marked WHERE "rejectReason" IS NOT NULL""")
def not_null_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that must not enter the ledger, with the reasons."""
    rows = standins.customers(spark, sf_dir).withColumn(
        "email", F.when(F.col("customerNumber") % 10 != 0, F.col("email"))
    )
    marked = quality.with_reject_reason(rows, quality.not_null_rules(["creditTerms", "email"]))
    return quality.rejected(marked).select("customerNumber", "creditTerms", "rejectReason")


@query(f"""
WITH {sql.CUSTOMERS},
flow AS (
  SELECT NOT ({sql.OFFERED}) AS fresh, coalesce(lower(creditTerms) LIKE '%days net%', FALSE) AS netTerms,
    coalesce(try_cast(split_part(creditTerms, ' ', 1) AS integer) > 7, FALSE) AS longer
  FROM orders LEFT JOIN parties ON c_custkey = o_custkey
)
SELECT count(*) AS invoices, count(*) FILTER (WHERE fresh) AS "notOffered",
  count(*) FILTER (WHERE fresh AND netTerms) AS "netTerms",
  count(*) FILTER (WHERE fresh AND netTerms AND longer) AS eligible
FROM flow""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices that reach each stage, in one pass."""
    orders = standins.table(spark, sf_dir, "orders")
    offered = (F.col("o_orderdate") < F.lit(standins.OFFERED_BEFORE)) & (F.col("o_orderstatus") == "F")
    parties = standins.customers(spark, sf_dir).select(
        F.col("customerNumber").alias("o_custkey"),
        terms.is_days_net(F.col("creditTerms")).alias("net"),
        F.coalesce(terms.long_enough(terms.leading_days(F.col("creditTerms"))), F.lit(False)).alias("longer"),
    )
    rows = orders.select("o_custkey", (~offered).alias("fresh")).join(parties, "o_custkey", "left")
    fresh, net = F.col("fresh"), F.col("fresh") & F.col("net")
    return quality.stage_counts(
        rows,
        {
            "invoices": F.lit(True),
            "notOffered": fresh,
            "netTerms": net,
            "eligible": net & F.col("longer"),
        },
    )


@query("""
SELECT 'o_orderstatus' AS field, o_orderstatus AS "distinctValue" FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders GROUP BY o_orderpriority""")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of two columns."""
    orders = standins.table(spark, sf_dir, "orders")
    parts = [
        orders.select(F.lit(c).alias("field"), F.col(c).alias("distinctValue")).distinct()
        for c in ("o_orderstatus", "o_orderpriority")
    ]
    return parts[0].unionByName(parts[1])
