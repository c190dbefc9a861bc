"""Attribute and credit-limit pivots, unit cost, first match, tier joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.catalog import query, sql
from netdays.operators import lookups, tiers
from netdays.operators.joins import spread_left_join
from netdays.params import SAMPLE_SUPPLIER
from netdays.sources import payables, standins


@query("""
SELECT p_partkey AS itemId, p_name AS "productCode", p_brand AS "productPack",
  cast(p_size AS varchar) AS "skuSize", p_type AS variant, least(p_brand, p_type) AS "subVariant" FROM part""")
def attribute_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name/value rows of each part back to columns; a repeated name takes its least value."""
    part = standins.table(spark, sf_dir, "part")
    pairs = part.select(
        F.col("p_partkey").alias("itemId"),
        F.expr(
            "stack(7, 'Product Code', p_name, 'Product Pack', p_brand, 'Size', cast(p_size AS string),"
            " 'Additional Description', p_type, 'Sub Variant', p_brand, 'Sub Variant', p_type,"
            " 'Unlisted', p_name) AS (elementName, elementValue)"
        ),
    )
    return lookups.item_attributes(pairs)


@query("""
SELECT o_custkey AS customerNumber,
  max(CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice AS decimal(20,2)) END) AS "kesCreditLimit",
  max(CASE WHEN o_orderstatus = 'O' THEN cast(o_totalprice AS decimal(20,2)) END) AS "usdCreditLimit",
  max(CASE WHEN o_orderstatus = 'P' THEN cast(o_totalprice AS decimal(20,2)) END) AS "gbpCreditLimit"
FROM orders GROUP BY o_custkey""")
def credit_limits_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest limit per customer and currency; order status stands for currency."""
    return lookups.credit_limits(_limits(spark, sf_dir), ["customerNumber"])


def _limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return standins.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customerNumber"),
        F.when(status == "F", "KES").when(status == "O", "USD").otherwise("GBP").alias("currencyCode"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("creditLimit"),
    )


@query("""
SELECT o_custkey AS customerNumber FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderpriority) > 1""")
def ambiguous_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys on which a one-row look-up would fail."""
    rows = standins.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customerNumber"), "o_orderpriority"
    )
    return lookups.keys_with_many_values(rows, ["customerNumber"], "o_orderpriority")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN p_size % 5 <> 0 THEN round(cast(p_retailprice AS decimal(12,2)) * cast(1.23456 AS decimal(6,5)), 5) END AS "unitCost"
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def unit_cost_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit cost per line; zero costs and other cost types do not count."""
    part = standins.table(spark, sf_dir, "part")
    kinds = F.explode(F.array(F.lit(1), F.lit(2))).alias("costTypeId")
    cost = F.col("p_retailprice").cast("decimal(12,2)") * F.lit("1.23456").cast("decimal(6,5)")
    costs = part.select("*", kinds).select(
        F.col("p_partkey").alias("itemId"),
        F.lit(1).alias("organizationId"),
        F.when(F.col("p_size") % 5 == 0, F.lit(0)).otherwise(cost).alias("itemCost"),
        "costTypeId",
    )
    lines = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_partkey").alias("itemId"), F.lit(1).alias("organizationId"),
    )
    return lookups.look_up(
        lines, lookups.nonzero_unit_cost(costs), ["itemId", "organizationId"]
    ).drop("itemId", "organizationId")


_COST = "round(cast(p_retailprice AS decimal(12,2)) * cast(1.23456 AS decimal(6,5)), 5)"


def _repeated_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit costs of which some items have two equal and some two different rows."""
    key = F.col("p_partkey")
    cost = F.round(F.col("p_retailprice").cast("decimal(12,2)") * F.lit("1.23456").cast("decimal(6,5)"), 5)
    rows = F.when(key % 6 == 0, F.array(cost, cost)).when(key % 6 == 1, F.array(cost, cost + 1)).otherwise(F.array(cost))
    return standins.table(spark, sf_dir, "part").select(
        key.alias("itemId"), F.lit(1).alias("organizationId"), F.explode(rows).alias("itemCost"), F.lit(2).alias("costTypeId")
    )


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey % 6 <> 1 THEN {_COST} END AS "unitCost",
  coalesce(p_partkey % 6 = 1, FALSE) AS ambiguous
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def guarded_unit_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit cost per line where items repeat: as many rows as lines, ambiguous items without a cost."""
    item = ["itemId", "organizationId"]
    costs = lookups.nonzero_unit_cost(_repeated_costs(spark, sf_dir))
    lines = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("itemId"), F.lit(1).alias("organizationId")
    )
    single = lookups.single_row(costs, item, ["unitCost"], "reject", "ambiguous")
    rows = spread_left_join(lines, single, item, ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", "unitCost", F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"))


@query("""
WITH cells AS (
  SELECT o_custkey AS customerNumber,
    CASE o_orderstatus WHEN 'F' THEN 'kesCreditLimit' WHEN 'O' THEN 'usdCreditLimit' ELSE 'gbpCreditLimit' END AS col,
    min(cast(o_totalprice AS decimal(20,2))) AS low, max(cast(o_totalprice AS decimal(20,2))) AS high
  FROM orders GROUP BY 1, 2
)
SELECT customerNumber,
  max(CASE WHEN col = 'kesCreditLimit' AND low = high THEN low END) AS "kesCreditLimit",
  max(CASE WHEN col = 'usdCreditLimit' AND low = high THEN low END) AS "usdCreditLimit",
  max(CASE WHEN col = 'gbpCreditLimit' AND low = high THEN low END) AS "gbpCreditLimit",
  nullif(concat_ws(',', max(CASE WHEN col = 'kesCreditLimit' AND low <> high THEN col END),
    max(CASE WHEN col = 'usdCreditLimit' AND low <> high THEN col END),
    max(CASE WHEN col = 'gbpCreditLimit' AND low <> high THEN col END)), '') AS ambiguous
FROM cells GROUP BY customerNumber""")
def guarded_credit_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one limit per customer and currency, with the currencies that have several."""
    return lookups.single_credit_limits(_limits(spark, sf_dir), ["customerNumber"], "reject", "ambiguous")


@query("""
WITH accounts AS (
  SELECT DISTINCT l_suppkey AS vendorId, p_partkey, p_brand, p_type, p_name FROM lineitem JOIN part ON p_partkey = l_partkey
),
complete AS (SELECT vendorId, min(p_partkey) AS k FROM accounts WHERE p_brand <> 'Brand#1' GROUP BY 1),
anyone AS (SELECT vendorId, min(p_partkey) AS k FROM accounts GROUP BY 1)
SELECT s_suppkey AS vendorId, b.p_brand AS bankName, b.p_type AS bankBranchName,
  'ACC' || a.p_partkey AS bankAccountNumber, a.p_name AS bankAccountName
FROM supplier
LEFT JOIN complete c ON c.vendorId = s_suppkey LEFT JOIN accounts b ON b.vendorId = c.vendorId AND b.p_partkey = c.k
LEFT JOIN anyone y ON y.vendorId = s_suppkey LEFT JOIN accounts a ON a.vendorId = y.vendorId AND a.p_partkey = y.k""")
def first_match_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank of the first account with a listed bank, number of the first account at all."""
    relations = standins.supplier_relations(spark, sf_dir)
    vendors = standins.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vendorId"), F.col("s_suppkey").alias("aps_party_id")
    )
    rows = lookups.look_up(vendors, payables.supplier_banks(relations), "aps_party_id")
    rows = lookups.look_up(rows, payables.supplier_accounts(relations), "aps_party_id")
    return rows.select(
        "vendorId", "bankName", "bankBranchName", "bankAccountNumber", "bankAccountName"
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoiceNumber"),
        ((F.col("o_orderkey") % 13) * 5).cast("int").alias("termDays"),
    )


_EARLY = sql.tier_case("termDays", {k: t.early_days for k, t in SAMPLE_SUPPLIER.tiers.items()})
_PERCENT = sql.tier_case("termDays", {k: t.percent for k, t in SAMPLE_SUPPLIER.tiers.items()})
_DAYS_SQL = "SELECT o_orderkey AS invoiceNumber, cast(o_orderkey % 13 * 5 AS integer) AS termDays FROM orders"


@query(f"""
SELECT invoiceNumber, termDays, cast({_EARLY} AS integer) AS earlyDays, cast({_PERCENT} AS decimal(7,4)) AS percent
FROM ({_DAYS_SQL})""")
def tier_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier by term days, 0 where there is none."""
    table = tiers.tier_table(spark, SAMPLE_SUPPLIER)
    return tiers.join_tiers(_days(spark, sf_dir), table, "termDays")


@query(f"""
SELECT invoiceNumber, termDays, cast({_EARLY} AS integer) AS earlyDays, cast({_PERCENT} AS decimal(7,4)) AS percent
FROM ({_DAYS_SQL}) WHERE termDays IN ({', '.join(map(str, SAMPLE_SUPPLIER.tiers))})""")
def tier_join_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only terms that have a tier."""
    table = tiers.tier_table(spark, SAMPLE_SUPPLIER)
    return tiers.join_tiers(_days(spark, sf_dir), table, "termDays", strict=True)
