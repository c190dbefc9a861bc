from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from netdays.operators.consolidate import consolidate_to_headers
from netdays.params import SAMPLE_CUSTOMER, SAMPLE_SUPPLIER
from netdays.sources.ledger import Ledger
from netdays.streaming.offers import customer_offer_stream, file_stream, supplier_offer_stream, without_repeats

HEADER = (
    "invoiceNumber string, invoiceDate date, invoiceTime timestamp, customerKey string,"
    " invoiceCurrencyCode string"
)


def header(number, day=1):
    time = dt.datetime(2024, 3, day)
    return (number, time.date(), time, "k_1", "KES")


def test_stream_in_several_batches_and_a_replay(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), HEADER).coalesce(1).write.mode("append").parquet(feed)

    lines = spark.createDataFrame(
        [(str(i), D("10.00")) for i in range(1, 9) for _ in range(2)],
        "invoiceNumber string, invoiceGrossValue decimal(18,2)",
    )
    customers = spark.createDataFrame(
        [("k_1", 5, "30 Days Net")], "customerKey string, customerId bigint, creditTerms string"
    )
    offered = spark.createDataFrame([("8",)], "invoiceNumber string")

    def run(state):
        stream = file_stream(spark, feed, spark.createDataFrame([], HEADER).schema, files_per_batch=1)
        query = customer_offer_stream(
            stream, lambda batch: consolidate_to_headers(batch, lines), customers, ledger,
            SAMPLE_CUSTOMER, str(tmp_path / state), offered_elsewhere=offered,
        )
        query.awaitTermination()
        return sorted(r.invoiceNumber for r in ledger.read("customerOffers").collect())

    arrive(header("1"), header("2"), header("2"), header("8"))
    arrive(header("2"), header("3", 2))
    assert run("state") == ["1", "2", "3"]
    arrive(header("4", 1), header("3", 2))
    assert run("state") == ["1", "2", "3", "4"]
    # All files once more, as after a lost checkpoint.
    assert run("fresh-state") == ["1", "2", "3", "4"]
    stored = ledger.read("customerOffers")
    assert stored.agg(F.countDistinct("customerOfferId")).head()[0] == 4
    assert {r.creditAmount for r in stored.collect()} == {D("20.00")}


def test_repeats_within_a_delay(spark, tmp_path):
    feed = str(tmp_path / "feed")
    spark.createDataFrame([header("1"), header("1"), header("2", 2)], HEADER).coalesce(1).write.parquet(feed)
    stream = without_repeats(
        file_stream(spark, feed, spark.createDataFrame([], HEADER).schema), "invoiceNumber", "invoiceTime", "7 days"
    )
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).format("parquet").start(out)
    )
    query.awaitTermination()
    assert sorted(r.invoiceNumber for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_supplier_stream_in_two_batches(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    kind = (
        "vendorId bigint, invoiceNumber string, invoiceDate date, glDate date, amount decimal(18,2),"
        " currency string, rate decimal(10,4)"
    )

    def arrive(*numbers):
        rows = [(5, n, dt.date(2024, 3, 1), dt.date(2024, 3, 4), D("10.00"), "KES", None) for n in numbers]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(feed)

    suppliers = spark.createDataFrame(
        [(5, 50, "Net 30 Days Net")], "vendorId bigint, supplierId bigint, creditTerms string"
    )
    offered = spark.createDataFrame([("5_C",)], "invoiceUniqueKey string")
    arrive("A", "A", "B", "C")
    for expected in (["A", "B"], ["A", "B", "D"]):
        stream = file_stream(spark, feed, spark.createDataFrame([], kind).schema)
        supplier_offer_stream(
            stream, suppliers, ledger, SAMPLE_SUPPLIER, str(tmp_path / "state"), offered_elsewhere=offered
        ).awaitTermination()
        assert sorted(r.invoiceNumber for r in ledger.read("supplierPayment").collect()) == expected
        arrive("B", "D")


def test_invoices_of_a_late_supplier_wait(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    kind = (
        "vendorId bigint, invoiceNumber string, invoiceDate date, glDate date, amount decimal(18,2),"
        " currency string, rate decimal(10,4)"
    )
    known = [(5, 50, "Net 30 Days Net")]

    def run():
        stream = file_stream(spark, feed, spark.createDataFrame([], kind).schema, files_per_batch=1)
        supplier_offer_stream(
            stream, lambda: spark.createDataFrame(known, "vendorId bigint, supplierId bigint, creditTerms string"),
            ledger, SAMPLE_SUPPLIER, str(tmp_path / "state"),
        ).awaitTermination()
        return sorted(r.invoiceNumber for r in ledger.read("supplierPayment").collect())

    def arrive(vendor, number):
        rows = [(vendor, number, dt.date(2024, 3, 1), dt.date(2024, 3, 4), D("10.00"), "KES", None)]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(feed)

    arrive(5, "A")
    arrive(6, "B")
    arrive(5, "C")
    assert run() == ["A", "C"]
    known.append((6, 60, "Net 30 Days Net"))
    arrive(5, "D")
    assert run() == ["A", "B", "C", "D"]
    assert ledger.rejects("supplierPayment").count() == 0


def test_invoices_of_a_late_customer_wait(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    lines = spark.createDataFrame([("1", D("10.00")), ("2", D("20.00"))], "invoiceNumber string, invoiceGrossValue decimal(18,2)")
    schema = "customerKey string, customerId bigint, creditTerms string"
    known = []

    def run(number):
        spark.createDataFrame([header(number)], HEADER).coalesce(1).write.mode("append").parquet(feed)
        stream = file_stream(spark, feed, spark.createDataFrame([], HEADER).schema)
        customer_offer_stream(
            stream, lambda batch: consolidate_to_headers(batch, lines), lambda: spark.createDataFrame(known, schema),
            ledger, SAMPLE_CUSTOMER, str(tmp_path / "state"),
        ).awaitTermination()
        return sorted(r.invoiceNumber for r in ledger.read("customerOffers").collect())

    assert run("1") == []
    known.append(("k_1", 5, "30 Days Net"))
    assert run("2") == ["1", "2"]
