"""What the plans look like when no table is small enough to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from netdays.operators import joins, lookups
from netdays.operators.consolidate import consolidate_lines
from netdays.params import SAMPLE_CUSTOMER
from netdays.plans.receivables import receivable_offers
from netdays.sources import standins

SF = "/root/testdata/sf0.001"


def plan_text(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_and_no_cross_join(spark, name):
    text = plan_text(registry.queries()[name](spark, SF))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoop", text)


def test_offer_plan(plain_joins):
    text = plan_text(registry.queries()["ar_offers"](plain_joins, SF))
    assert "LeftAnti" in text
    assert "GreaterThanOrEqual(o_orderdate,1999" in text
    orders_read = re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\).*?ReadSchema: (\S+)", text, re.S)
    assert orders_read
    # Invoices are shuffled by number once, by customer number and by key.
    assert text.count("hashpartitioning(invoiceNumber") == 3
    assert text.count("hashpartitioning(customerNumber") == 2
    assert text.count("hashpartitioning(customerKey") == 2


def test_payable_plan_reads_a_date_window(spark):
    text = plan_text(registry.queries()["ap_offers"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate," in text and "LessThan(l_shipdate," in text


def test_consolidation_combines_before_its_shuffle(spark):
    lines = standins.invoice_lines(spark, SF).withColumns(
        {
            "invoiceDate": F.current_date(),
            "customerNumber": F.col("lineId"),
            "invoiceCurrencyCode": F.lit("USD"),
            "customerKey": F.lit("k"),
        }
    )
    text = plan_text(consolidate_lines(lines, ["lineId"]))
    assert text.count("Exchange") == 1
    assert text.index("min_by") < text.index("Exchange") < text.rindex("partial_min_by")


@pytest.fixture
def small_skew(plain_joins):
    """Thresholds so low that a few thousand rows count as a skewed partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: plain_joins.conf.get(k) for k in settings}
    for key, value in settings.items():
        plain_joins.conf.set(key, value)
    yield plain_joins
    for key, value in before.items():
        plain_joins.conf.set(key, value)


def invoices(spark, n):
    """A customer that holds a third of the invoices, and many small ones."""
    number = F.col("id")
    hot = number % 3 == 0
    return spark.range(0, n, numPartitions=8).select(
        number.alias("invoiceNumber"),
        F.lit("2024-01-30").cast("date").alias("invoiceDate"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), number % 997)).alias("customerKey"),
        (F.pmod(F.xxhash64("id"), F.lit(10**8)) / 100).cast("decimal(20,2)").alias("invoiceGrossValue"),
        F.when(number % 2 == 0, "USD").otherwise("KES").alias("invoiceCurrencyCode"),
    )


def test_hot_customer_is_split(small_skew):
    spark = small_skew
    customers = spark.range(998).select(
        F.when(F.col("id") == 997, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("customerKey"),
        F.col("id").alias("customerId"),
        F.lit("30 Days Net").alias("creditTerms"),
    )
    offers = receivable_offers(invoices(spark, 60_000), customers, SAMPLE_CUSTOMER)
    rows = offers.collect()
    assert "skew=true" in plan_text(offers)
    assert len(rows) == 60_000
    assert len({r.invoiceNumber for r in rows}) == 60_000


def test_hot_document_is_split_beside_an_aggregated_table(small_skew):
    spark = small_skew
    rows = invoices(spark, 60_000)
    members = spark.range(1500).select(F.concat(F.lit("k"), F.col("id") * 2).alias("customerKey"))
    members = members.union(members).union(spark.createDataFrame([("hot",)], "customerKey string"))
    flagged = lookups.membership_flag(rows, members, "customerKey", "flag", ["invoiceNumber"])
    got = {r.flag: r["count"] for r in flagged.groupBy("flag").count().collect()}
    expected = rows.select(
        ((F.col("customerKey") == "hot") | (F.col("invoiceNumber") % 997 % 2 == 0)).alias("m")
    ).groupBy("m").count().collect()
    assert got == {"Yes" if r.m else "No": r["count"] for r in expected}
    # The hot key is spread over partitions that hold a fraction of it each.
    parts = flagged.filter("customerKey = 'hot'").select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() >= 4


def test_hot_invoice_is_split_before_it_is_consolidated(small_skew):
    """The join is split although the aggregate above it then needs a shuffle."""
    spark = small_skew
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000)
    lines = spark.range(0, 60_000, numPartitions=8).select(
        number.alias("invoiceNumber"),
        F.col("id").alias("lineId"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).cast("decimal(18,2)").alias("invoiceGrossValue"),
    )
    headers = invoices(spark, 2000).drop("invoiceGrossValue").withColumn("customerNumber", F.lit(1))
    flat = consolidate_lines(lines.join(headers, "invoiceNumber"), ["lineId"])
    got = {r.invoiceNumber: r.invoiceGrossValue for r in flat.collect()}
    assert "skew=true" in plan_text(flat)
    sums = lines.groupBy("invoiceNumber").agg(F.sum("invoiceGrossValue").alias("s")).collect()
    assert got == {r.invoiceNumber: r.s for r in sums}


def test_hot_invoice_is_consolidated(small_skew):
    spark = small_skew
    lines = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("invoiceNumber"),
        F.col("id").alias("lineId"),
        F.lit("1.25").cast("decimal(18,2)").alias("invoiceGrossValue"),
        F.lit("2024-01-30").cast("date").alias("invoiceDate"),
        F.col("id").alias("customerNumber"),
        F.when(F.col("id") > 0, "USD").alias("invoiceCurrencyCode"),
        F.lit("k").alias("customerKey"),
    )
    hot = consolidate_lines(lines, ["lineId"]).filter("invoiceNumber = 0").head()
    assert (str(hot.invoiceGrossValue), hot.customerNumber, hot.invoiceCurrencyCode) == ("25000.00", 0, "USD")


def test_only_heavy_keys_are_copied(small_skew):
    spark = small_skew
    even = spark.range(0, 30_000, numPartitions=8).select((F.col("id") % 5000).alias("k"), F.col("id").alias("n"))
    table = spark.range(5000).select((F.col("id") % 4000).alias("k")).groupBy("k").agg(F.count("*").alias("c"))
    assert joins.heavy_keys(even, ["k"]) == {}
    plain = joins.spread_left_join(even, table, ["k"], ["n"])
    assert "_piece" not in plan_text(plain) and plain.columns == ["k", "n", "c"]
    # A third of the rows on one key, another third without one.
    skewed = even.withColumn("k", F.when(F.col("n") % 3 == 0, 17).when(F.col("n") % 3 == 1, F.col("k")))
    heavy = joins.heavy_keys(skewed, ["k"])
    assert sorted(heavy.values()) == [17, 17]
    assert joins.heavy_keys(skewed.limit(0), ["k"]) == {}
    spread = joins.spread_left_join(skewed, table, ["k"], ["n"])
    expected = skewed.join(table, ["k"], "left")
    assert spread.exceptAll(expected).isEmpty() and spread.count() == 30_000
    sizes = spread.where("k = 17").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) < 8_000
    copied = spread.select("k", "c").distinct().where("k is not null").count()
    assert copied == skewed.where("k is not null").select("k").distinct().count()


def shuffles(frame):
    return plan_text(frame).count("Exchange hashpartitioning")


def test_customer_extract_looks_account_sites_up_once(plain_joins):
    """All look-ups by account site share one shuffle and one aggregate."""
    frame = registry.queries()["ar_customer_extract"](plain_joins, SF)
    assert shuffles(frame) <= 60
    assert shuffles(registry.queries()["ar_customer_master"](plain_joins, SF)) <= 30


def test_supplier_master_multiplies_nothing(plain_joins):
    frame = registry.queries()["ap_supplier_master"](plain_joins, SF)
    text = plan_text(frame)
    assert shuffles(frame) <= 8 and "LeftSemi" in text and text.count("SortMergeJoin") <= 4
