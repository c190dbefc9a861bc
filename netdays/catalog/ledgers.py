"""The ledger as a checked result: index, updates, compaction, parties, queue and line streams."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netdays import schemas
from netdays.catalog import query, sql
from netdays.catalog.parties import SITE_SQL
from netdays.catalog.payable import SUPPLIER_SQL, ap_offers
from netdays.catalog.receivable import ar_offers
from netdays.operators.consolidate import consolidate_to_headers
from netdays.operators.incremental import not_yet_offered, only_keys, watermark
from netdays.params import SAMPLE_CUSTOMER, SAMPLE_SUPPLIER
from netdays.plans.payables import canonical_invoices
from netdays.plans.runs import append_checked, run_payables, run_receivables, settle_payables
from netdays.session import new_scratch_path, written
from netdays.sources import standins
from netdays.sources.ledger import MONTH, Ledger
from netdays.sources.waiting import Waiting
from netdays.streaming.lines import line_offer_stream
from netdays.streaming.offers import customer_offer_stream, file_stream

_AR = sql.receivable_offers(SAMPLE_CUSTOMER)
_AP = sql.payable_offers(SAMPLE_SUPPLIER)


def _new_ledger(spark: SparkSession) -> Ledger:
    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    ledger.create()
    return ledger


def _filled(spark: SparkSession, sf_dir: str, batches: int) -> Ledger:
    """A ledger of all customer offers, appended in some batches."""
    ledger = _new_ledger(spark)
    offers = written(
        ar_offers(spark, sf_dir).withColumn("offerStatus", F.lit(schemas.NOT_SENT)), "offers"
    )
    for number in range(batches):
        some = offers.where(F.col("invoiceNumber") % batches == number)
        append_checked(ledger, "customerOffers", some, "customerOfferId")
    return ledger


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber FROM ({_AR}) WHERE invoiceNumber % 50 = 0""")
def ledger_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which invoices of a load the ledger holds, from its key index."""
    orders = standins.table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0")
    load = orders.select(F.col("o_orderkey").cast("string").alias("invoiceNumber"))
    return _filled(spark, sf_dir, 2).held("customerOffers", load, "invoiceNumber")


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, customerKey, creditAmount, discountRate,
  cast(date_trunc('month', invoiceDate) AS date) AS "invoiceMonth", 1 AS folders
FROM ({_AR})""")
def ledger_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of three appends packed, with the number of folders their month lies in."""
    ledger = _filled(spark, sf_dir, 3)
    ledger.compact("customerOffers")
    months = [(e.month,) for e in ledger.entries("customerOffers")]
    folders = spark.createDataFrame(months, f"{MONTH} date").groupBy(MONTH).agg(F.count("*").cast("int").alias("folders"))
    return ledger.read("customerOffers").join(folders, MONTH).select(
        "invoiceNumber", "customerKey", "creditAmount", "discountRate", MONTH, "folders"
    )


_DECIDED = "o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate >= TIMESTAMP '2000-03-01' AND o_orderdate < TIMESTAMP '2000-04-01'"


@query(f"""
WITH offers AS ({_AR})
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, creditAmount,
  CASE WHEN {_DECIDED} THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'accepted' ELSE 'rejected' END ELSE 'not_sent' END AS offerStatus,
  invoiceDate BETWEEN DATE '2000-03-01' AND DATE '2000-03-31'
    AND EXISTS (SELECT 1 FROM offers f JOIN orders ON o_orderkey = f.invoiceNumber WHERE {_DECIDED}) AS rewritten
FROM offers JOIN orders ON o_orderkey = invoiceNumber""")
def ledger_status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on the offers of one month, and which offers were written anew for it."""
    ledger = _filled(spark, sf_dir, 1)
    before = {e.batch for e in ledger.entries("customerOffers")}
    orders = standins.table(spark, sf_dir, "orders").where(
        "o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate >= '2000-03-01' AND o_orderdate < '2000-04-01'"
    )
    decisions = orders.select(
        F.col("o_orderkey").cast("string").alias("invoiceNumber"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "accepted").otherwise("rejected").alias("offerStatus"),
    )
    ledger.update("customerOffers", decisions, "invoiceNumber", "offerStatus")
    anew = [e.month for e in ledger.entries("customerOffers") if e.batch not in before]
    return ledger.read("customerOffers").select(
        "invoiceNumber", "creditAmount", "offerStatus", F.col(MONTH).isin(anew).alias("rewritten")
    )


_LONG_NAME = "CASE WHEN s_suppkey % 5 = 0 THEN repeat(s_name, 20) ELSE s_name END"


@query(f"""
WITH rows AS (
  SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 7 <> 2 AND length({_LONG_NAME}) > 255 THEN 'name too long' END,
    CASE WHEN s_suppkey % 11 = 0 THEN 'phone too long' END) AS reason
  FROM supplier
)
SELECT cast(s_suppkey AS varchar) AS rejectKey, reason AS rejectReason, 0 AS loaded FROM rows WHERE reason <> ''
UNION ALL
SELECT NULL, NULL, cast(count(*) AS integer) FROM rows WHERE reason = ''""")
def ledger_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with texts longer than their column may hold, and how many were loaded."""
    key = F.col("s_suppkey")
    ledger = _new_ledger(spark)
    rows = standins.table(spark, sf_dir, "supplier").select(
        key.alias("vendorId"),
        F.when(key % 7 == 2, None).when(key % 5 == 0, F.repeat("s_name", F.lit(20))).otherwise(F.col("s_name")).alias("name"),
        F.when(key % 11 == 0, F.repeat(F.lit("5"), F.lit(51))).alias("phone"),
    )
    loaded, _ = append_checked(ledger, "suppliers", rows, "supplierId")
    none = F.lit(None).cast("string")
    summary = spark.range(1).select(none.alias("rejectKey"), none.alias("rejectReason"), F.lit(loaded).alias("loaded"))
    return ledger.rejects("suppliers").select("rejectKey", "rejectReason", F.lit(0).alias("loaded")).unionByName(summary)


_CREATED = dt.datetime(2001, 12, 31, 6)


@query(f"""
WITH master AS (
  SELECT customerKey, min(customerNumber) AS customerNumber, min(name) AS name, min(email) AS email,
    min(customerType) AS customerType, arg_min(creditTerms, cast(siteUseId AS bigint)) AS creditTerms
  FROM ({SITE_SQL}) GROUP BY customerKey
),
wanted AS (
  SELECT DISTINCT {sql.normalized("' ' || n_name || '-' || o_orderpriority")} || '_' || c_custkey AS customerKey
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND cast(o_orderdate AS date) >= DATE '1999-12-29'
)
SELECT customerNumber, customerKey, name, email, customerType, creditTerms, TIMESTAMP '2001-12-31 06:00:00' AS createAt
FROM master JOIN wanted USING (customerKey) WHERE creditTerms IS NOT NULL""")
def ar_ledger_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that two receivable runs have loaded."""
    relations = standins.receivable_relations(spark, sf_dir)
    ledger = _new_ledger(spark)
    for as_of in (dt.date(2000, 2, 29), standins.AS_OF):
        run_receivables(ledger, relations, SAMPLE_CUSTOMER, as_of, _CREATED)
    return ledger.read("customers").select(
        "customerNumber", "customerKey", "name", "email", "customerType", "creditTerms",
        F.col("createAt").cast("timestamp_ntz").alias("createAt"),
    )


@query(f"""
WITH {sql.PAYABLES}
SELECT vendorId, min(supplierName) AS name, min(supplierType) AS supplierType, min(creditTerms) AS creditTerms,
  min(phone) AS phone, min(email) AS email
FROM ({SUPPLIER_SQL}) WHERE vendorId IN (SELECT vendorId FROM payables WHERE glDate BETWEEN DATE '2000-04-30' AND DATE '2001-12-31')
GROUP BY vendorId""")
def ap_ledger_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers that two payable runs have loaded."""
    relations = standins.supplier_side_relations(spark, sf_dir)
    ledger = _new_ledger(spark)
    for as_of in (dt.date(2000, 6, 30), standins.AS_OF):
        run_payables(ledger, relations, SAMPLE_SUPPLIER, as_of, org_id=82)
    return ledger.read("suppliers").select("vendorId", "name", "supplierType", "creditTerms", "phone", "email")


# A batch of a feed lies in a file per so many rows, up to so many files.
FEED_ROWS = 250_000
FEED_FILES = 16


def _feed(batches: list[tuple[DataFrame, int]], path: str) -> int:
    """Write the batches of a feed in their order, each given with its row count; how many files each has.

    All have as many files as the batches of more than :data:`FEED_FILES` rows can fill, so that a
    stream that takes that number of files takes a batch. A batch of fewer rows gets one file with
    all of them, and empty files.
    """
    many = [n for _, n in batches if n > FEED_FILES]
    files = min(FEED_FILES, max(1, max(many, default=0) // FEED_ROWS))
    for rows, n in batches:
        # Dealt out one after the other from each task, so every file has rows where each task has enough.
        full = n >= files * FEED_FILES
        (rows.repartition(files) if full and files > 1 else rows.coalesce(1)).write.mode("append").parquet(path)
        for _ in range(0 if full else files - 1):
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files


def _spread(parties: DataFrame) -> DataFrame:
    """Parties that every batch of a stream joins, written once and in a file for each core."""
    return written(parties.repartition(parties.sparkSession.sparkContext.defaultParallelism), "parties")


@query(f"""
SELECT 'AR' AS side, cast(invoiceNumber AS varchar) AS invoiceKey, creditAmount, discountRate FROM ({_AR})
UNION ALL
SELECT 'AP', invoiceUniqueKey, creditAmount, discountRate FROM ({_AP})
UNION ALL
SELECT 'waiting', NULL, 0, 0""")
def late_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices whose party comes later: customers during a stream, suppliers before a run."""
    ledger = _new_ledger(spark)
    offered = standins.offered_headers(spark, sf_dir)
    since = watermark(offered, standins.AS_OF)
    orders = standins.table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit(since))
    halves = [orders.where(f"o_orderkey % 2 = {k}") for k in (0, 1)]
    feed = new_scratch_path(spark, "feed")
    files = _feed([(half, half.count()) for half in halves], feed)
    asked: list[int] = []

    def customers() -> DataFrame:
        asked.append(1)
        known = F.col("c_mktsegment") != "BUILDING" if len(asked) == 1 else None
        return _spread(standins.customers(spark, sf_dir, known))

    def to_invoices(batch: DataFrame) -> DataFrame:
        lines = only_keys(standins.invoice_lines(spark, sf_dir), batch.select("invoiceNumber"), "invoiceNumber")
        return standins.with_customer_key(consolidate_to_headers(batch, lines), spark, sf_dir)

    stream = file_stream(spark, feed, orders.schema, files_per_batch=files)
    customer_offer_stream(
        standins.as_headers(stream), to_invoices, customers, ledger, SAMPLE_CUSTOMER,
        new_scratch_path(spark, "stream-state"), offered_elsewhere=offered,
    ).awaitTermination()

    payables = standins.offered_payables(spark, sf_dir)
    extract = standins.payable_invoices(spark, sf_dir, watermark(payables, standins.AS_OF), standins.AS_OF)
    invoices = canonical_invoices(extract, with_gl_date=True)
    new = written(not_yet_offered(invoices, payables, "invoiceUniqueKey"), "new-payables")
    suppliers = _spread(standins.suppliers(spark, sf_dir))
    settle_payables(ledger, new, suppliers.where("vendorId % 2 = 0"), SAMPLE_SUPPLIER)
    settle_payables(ledger, new.limit(0), suppliers, SAMPLE_SUPPLIER)

    amounts = ("creditAmount", "discountRate")
    sides = [
        ledger.read("customerOffers").select(F.lit("AR").alias("side"), F.col("invoiceNumber").alias("invoiceKey"), *amounts),
        ledger.read("supplierPayment").select(F.lit("AP").alias("side"), F.col("invoiceUniqueKey").alias("invoiceKey"), *amounts),
    ]
    left = sum(Waiting(ledger, t).rows().count() for t in ("customerOffers", "supplierPayment"))
    zero = F.lit(0).cast("decimal(20,4)")
    sides.append(spark.range(1).select(
        F.lit("waiting").alias("side"), F.lit(None).cast("string").alias("invoiceKey"),
        F.lit(left).cast("decimal(20,2)").alias("creditAmount"), zero.alias("discountRate"),
    ))
    return reduce(DataFrame.unionByName, sides)


def _line_feed(spark: SparkSession, sf_dir: str) -> tuple[str, StructType, int]:
    """The lines of new invoices in four batches by date; odd and even lines part at different days,
    so that invoices of the days between are split over two batches. Two lines without a number then
    move the time on, and lines of the first week come once more, too late. With the number
    of files that a batch has."""
    offered = standins.offered_headers(spark, sf_dir)
    headers = standins.invoice_headers(spark, sf_dir, watermark(offered, standins.AS_OF))
    keyed = standins.with_customer_key(not_yet_offered(headers, offered, "invoiceNumber"), spark, sf_dir)
    lines = written(
        standins.invoice_lines(spark, sf_dir).join(keyed, "invoiceNumber").select(
            F.col("invoiceNumber").cast("string").alias("invoiceNumber"), "lineId", "invoiceGrossValue",
            F.col("invoiceDate").cast("timestamp").alias("invoiceTime"), "invoiceDate", "invoiceCurrencyCode", "customerKey",
        ),
        "lines",
    )
    first, last = lines.agg(F.min("invoiceDate"), F.max("invoiceDate")).first()
    quarter = (last - first).days // 4 + 1
    shifted = F.datediff("invoiceDate", F.lit(first)) - F.when((F.col("lineId") / 10**18).cast("int") % 2 == 0, 1).otherwise(0)
    batch = F.floor(F.greatest(shifted, F.lit(0)) / quarter)
    early = F.col("invoiceDate") < F.lit(first + dt.timedelta(days=7))
    *sizes, late_lines = lines.agg(*[F.count_if(batch == k) for k in range(4)], F.count_if(early)).first()
    batches = [(lines.where(batch == k), sizes[k]) for k in range(4)]

    def silent(days: int) -> DataFrame:
        time = dt.datetime.combine(last, dt.time()) + dt.timedelta(days=days)
        row = (None, None, None, time, None, None, None)
        return spark.createDataFrame([row], lines.schema)

    feed = new_scratch_path(spark, "feed")
    files = _feed([*batches, (silent(10), 1), (silent(11), 1), (lines.where(early), late_lines)], feed)
    return feed, lines.schema, files


def _streamed_lines(spark: SparkSession, sf_dir: str) -> Ledger:
    feed, schema, files = _line_feed(spark, sf_dir)
    ledger = _new_ledger(spark)
    line_offer_stream(
        file_stream(spark, feed, schema, files_per_batch=files), _spread(standins.customers(spark, sf_dir)), ledger,
        SAMPLE_CUSTOMER, new_scratch_path(spark, "stream-state"),
    ).awaitTermination()
    return ledger


@query(f"""
SELECT cast(invoiceNumber AS varchar) AS invoiceNumber, invoiceDate, customerId, customerKey, creditAmount,
  discountRate, cast(discountPercentage AS decimal(14,4)) AS discountPercentage, offeredPaymentDate
FROM ({_AR})""")
def streaming_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices out of a stream of lines, some split over two files, priced when complete."""
    return _streamed_lines(spark, sf_dir).read("customerOffers").select(
        "invoiceNumber", "invoiceDate", "customerId", "customerKey", "creditAmount", "discountRate",
        "discountPercentage", "offeredPaymentDate",
    )


@query(f"""
WITH wm AS (SELECT coalesce(max(cast(o_orderdate AS date)), DATE '2001-10-31') AS d FROM orders WHERE {sql.OFFERED}),
lines AS (
  SELECT l_orderkey, cast(o_orderdate AS date) AS day,
    l_linenumber * 1000000000000000000 + l_partkey * 10000000 + l_suppkey % 10000000 AS lineId
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE cast(o_orderdate AS date) >= (SELECT d FROM wm) AND NOT ({sql.OFFERED})
)
SELECT DISTINCT cast(l_orderkey AS varchar) AS rejectKey, 'line ' || lineId || ' came late' AS rejectReason
FROM lines WHERE day < (SELECT min(day) FROM lines) + 7""")
def streaming_late_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that came after their invoice was complete, kept with the rejects."""
    return _streamed_lines(spark, sf_dir).rejects("customerOffers").where(
        F.col("rejectReason").startswith("line ")
    ).select("rejectKey", "rejectReason")
