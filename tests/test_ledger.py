"""The commit log, the key index, updates by month, compaction and the waiting queue."""

from __future__ import annotations

import datetime as dt
import glob
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from netdays import schemas
from netdays.operators.updates import update_column
from netdays.plans import runs
from netdays.plans.runs import append_checked, settle
from netdays.sources import key_index, ledger as ledger_module
from netdays.sources.commits import CommitLog, ConcurrentCommit, Entry
from netdays.sources.ledger import Ledger
from netdays.sources.waiting import Waiting

AS_OF = dt.date(2024, 3, 31)


def offers(spark, first, last, month=1, gl=False):
    """Offers of invoices ``first`` to ``last`` in one month."""
    number = F.col("id").cast("string")
    rows = spark.range(first, last + 1).select(
        number.alias("invoiceNumber"), F.make_date(F.lit(2024), F.lit(month), (F.col("id") % 28 + 1).cast("int")).alias("invoiceDate"),
        F.lit(1).cast("bigint").alias("customerId"), F.lit("k").alias("customerKey"), F.lit(D("5.00")).alias("creditAmount"),
        *[F.lit(D("1.0000")).alias(c) for c in ("discountRate", "discountPercentage", "totalInterest")],
        *[F.lit(dt.date(2024, 5, 1)).alias(c) for c in ("originalPaymentDate", "offeredPaymentDate")],
        F.lit("not_sent").alias("offerStatus"),
    )
    return rows


@pytest.fixture
def ledger(spark, tmp_path):
    made = Ledger(spark, str(tmp_path / "ledger"))
    made.create()
    return made


def numbers(rows):
    return sorted(int(r.invoiceNumber) for r in rows.select("invoiceNumber").collect())


def test_log_gives_ids_and_watermark_without_a_scan(spark, ledger, monkeypatch):
    assert ledger.watermark("customerOffers", AS_OF) == dt.date(2024, 1, 31) and ledger.last_id("customerOffers") == 0
    for first, last, month in ((1, 30, 2), (31, 40, 1)):
        append_checked(ledger, "customerOffers", offers(spark, first, last, month), "customerOfferId")

    def no_read(self, table):
        raise AssertionError(f"{table} was read")

    monkeypatch.setattr(Ledger, "read", no_read)
    monkeypatch.setattr(Ledger, "_live", no_read)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("watermark", "watermark")
    assert ledger.watermark("customerOffers", AS_OF) == dt.date(2024, 2, 28)
    assert ledger.last_id("customerOffers") == 40
    assert list(jobs.getJobIdsForGroup("watermark")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ids_go_on_and_months_are_pruned(spark, ledger):
    for first, last, month in ((1, 30, 1), (31, 50, 2), (51, 60, 2)):
        append_checked(ledger, "customerOffers", offers(spark, first, last, month), "customerOfferId", created_at=dt.datetime(2024, 3, 1, 8))
    rows = ledger.read("customerOffers")
    assert sorted(r.customerOfferId for r in rows.collect()) == list(range(1, 61))
    assert {r.createAt for r in rows.collect()} == {dt.datetime(2024, 3, 1, 8)}
    january = rows.where(F.col("invoiceMonth") == dt.date(2024, 1, 1))
    assert "PartitionFilters: [isnotnull(invoiceMonth" in january._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert numbers(january) == list(range(1, 31))
    assert [e.rows for e in ledger.entries("customerOffers")] == [30, 20, 10]
    assert ledger.at(1).read("customerOffers").count() == 30 and ledger.at(0).read("customerOffers").count() == 0


@pytest.mark.parametrize("step", ["write_keys", "publish"])
def test_a_crash_between_data_and_log_leaves_the_ledger_as_it_was(spark, ledger, monkeypatch, step):
    append_checked(ledger, "customerOffers", offers(spark, 1, 5), "customerOfferId")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(*((key_index, "write_keys") if step == "write_keys" else (CommitLog, "publish")), crash)
        with pytest.raises(RuntimeError, match="lost"):
            append_checked(ledger, "customerOffers", offers(spark, 6, 9), "customerOfferId")
    assert numbers(ledger.read("customerOffers")) == [1, 2, 3, 4, 5] and ledger.keys("customerOffers").count() == 5
    append_checked(ledger, "customerOffers", offers(spark, 6, 9), "customerOfferId")
    assert sorted(r.customerOfferId for r in ledger.read("customerOffers").collect()) == list(range(1, 10))


def test_of_two_writers_one_is_refused(spark, ledger):
    before = ledger.version
    entry = Entry("customers", "x", None, 1, 7, dt.date(2024, 1, 2), None)
    assert ledger.log.publish((entry,), before) == before + 1
    assert ledger.log.entries(before + 1) == (entry,)
    with pytest.raises(ConcurrentCommit):
        ledger.log.publish((), before)
    assert ledger.log.versions() == [0, 1]
    assert not glob.glob(f"{ledger.root}/commits/draft*")
    again = Ledger(spark, ledger.root)
    again.create()
    assert again.version == 1 and again.last_id("customers") == 7


def test_small_load_reads_few_row_groups(spark, ledger, monkeypatch):
    monkeypatch.setattr(key_index, "ROW_GROUP_BYTES", 1 << 14)
    append_checked(ledger, "customerOffers", offers(spark, 1, 200_000), "customerOfferId")
    wanted = spark.range(1_000, 1_100).select(F.concat(F.lit("1"), F.col("id").cast("string")).alias("invoiceNumber"))
    absent = wanted.select(F.concat(F.lit("x"), "invoiceNumber").alias("invoiceNumber"))
    found = ledger.held("customerOffers", wanted.unionByName(absent), "invoiceNumber")
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in wanted.collect())
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "INSET" in scan.toString()
    assert scan.metrics().apply("numOutputRows").value() < 20_000


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_large_loads_and_numbers_give_the_same_keys(spark, ledger, monkeypatch, kind):
    append_checked(ledger, "customerOffers", offers(spark, 1, 50), "customerOfferId")
    wanted = spark.range(41, 61).select(F.col("id").cast(kind).alias("invoiceNumber"))
    wanted = wanted.unionByName(wanted).unionByName(wanted.select(F.lit(None).cast(kind).alias("invoiceNumber")))
    for limit in (1_000, 5):
        monkeypatch.setattr(key_index, "LITERALS", limit)
        held = ledger.held("customerOffers", wanted, "invoiceNumber")
        assert sorted(int(r[0]) for r in held.collect()) == list(range(41, 51))
        assert key_index.rows_held(ledger.keys("customerOffers"), wanted, "invoiceNumber").count() == 10


def test_update_rewrites_only_touched_months(spark, ledger):
    for month in (1, 2, 3):
        append_checked(ledger, "customerOffers", offers(spark, month * 100, month * 100 + 9, month), "customerOfferId")
    old = ledger.at(ledger.version)
    before = {e.month: e.batch for e in ledger.entries("customerOffers")}
    decided = spark.createDataFrame(
        [("203", "accepted", 1), ("203", "rejected", 2), ("209", "accepted", 1), ("999", "accepted", 1), (None, "x", 1), ("205", None, 3)],
        "invoiceNumber string, offerStatus string, place int",
    )
    assert ledger.update("customerOffers", decided, "invoiceNumber", "offerStatus", "place") == [dt.date(2024, 2, 1)]
    after = {e.month: e.batch for e in ledger.entries("customerOffers")}
    assert {m for m in before if before[m] != after[m]} == {dt.date(2024, 2, 1)}
    whole = update_column(old.read("customerOffers"), decided, "invoiceNumber", "offerStatus", "place")
    assert sorted(map(tuple, ledger.read("customerOffers").collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert {r.offerStatus for r in old.read("customerOffers").collect()} == {"not_sent"}
    assert ledger.last_id("customerOffers") == 30 and ledger.watermark("customerOffers", AS_OF) == dt.date(2024, 3, 28)
    assert ledger.update("customerOffers", decided.where("invoiceNumber = '999'"), "invoiceNumber", "offerStatus") == []


def test_compaction_keeps_rows_and_bounds_folders(spark, ledger):
    for k in range(5):
        rows = offers(spark, k * 10, k * 10 + 9, 1).unionByName(offers(spark, 1000 + k, 1000 + k, 2 if k < 1 else 3))
        append_checked(ledger, "customerOffers", rows, "customerOfferId")
    before = sorted(map(tuple, ledger.read("customerOffers").collect()))
    old = ledger.at(ledger.version)
    assert ledger.compact("customerOffers") == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    assert sorted(e.month for e in ledger.entries("customerOffers")) == [dt.date(2024, m, 1) for m in (1, 2, 3)]
    assert len(ledger.entries("customerOffers.keys")) == 1 and ledger.keys("customerOffers").count() == 55
    assert sorted(map(tuple, ledger.read("customerOffers").collect())) == before == sorted(map(tuple, old.read("customerOffers").collect()))
    files = [f for e in ledger.entries("customerOffers") for f in glob.glob(f"{ledger.root}/customerOffers/batch={e.batch}/invoiceMonth={e.month}/*.parquet")]
    assert len(files) == 3
    version = ledger.version
    assert ledger.compact("customerOffers") == [] and ledger.version == version
    append_checked(ledger, "customerOffers", offers(spark, 500, 501), "customerOfferId")
    assert ledger.last_id("customerOffers") == 57


def test_rows_that_are_too_long_are_rejects(spark, ledger):
    rows = spark.createDataFrame(
        [(1, "n" * 255, "30 Days Net"), (2, "n" * 256, "30 Days Net")], "vendorId bigint, name string, creditTerms string"
    )
    assert append_checked(ledger, "suppliers", rows, "supplierId") == (1, 1)
    assert [(r.rejectReason, r.rejectKey) for r in ledger.rejects("suppliers").collect()] == [("name too long", "2")]
    assert set(schemas.FIELD_LENGTHS) == set(ledger_module.TABLES)


INVOICE = "invoiceNumber string, customerKey string, invoiceCurrencyCode string, invoiceDate date, invoiceGrossValue decimal(18,2)"


def test_queue_hands_out_what_has_a_party_and_rewrites_only_its_batch(spark, ledger):
    def invoices(*rows):
        return spark.createDataFrame([(n, k, "KES", dt.date(2024, 3, 1), D("5.00")) for n, k in rows], INVOICE)

    queue = Waiting(ledger, "customerOffers")
    assert not queue
    assert queue.put(invoices(("1", "a"), ("2", "b"))) == 2 and queue.put(invoices(("2", "b"), ("3", "c"))) == 1
    assert queue.put(invoices(("3", "c"))) == 0
    batches = {e.batch for e in ledger.entries(queue.name)}
    parties = spark.createDataFrame([("c",), ("z",), (None,), ("c",)], "customerKey string")
    ready = queue.ready(parties)
    assert [r.invoiceNumber for r in ready.collect()] == ["3"]
    queue.acknowledge(ready)
    assert sorted(r.invoiceNumber for r in queue.rows().collect()) == ["1", "2"]
    assert {e.batch for e in ledger.entries(queue.name)} < batches
    queue.acknowledge(queue.ready(spark.createDataFrame([("a",)], "customerKey string")))
    assert [r.invoiceNumber for r in queue.rows().collect()] == ["2"]
    queue.acknowledge(queue.ready(parties))
    assert queue.rows().count() == 1


def test_settling_loses_nothing_when_it_dies_before_the_acknowledgement(spark, ledger, monkeypatch):
    def invoices(*rows):
        return spark.createDataFrame([(n, k, "KES", dt.date(2024, 3, 1), D("5.00")) for n, k in rows], INVOICE)

    def offer(due, parties):
        known = due.join(parties.select("customerKey").distinct(), "customerKey", "left_semi").select("invoiceNumber")
        rows = offers(spark, 1, 9).join(known, "invoiceNumber", "left_semi")
        return append_checked(ledger, "customerOffers", rows, "customerOfferId")

    def run(rows, *parties):
        known = spark.createDataFrame([(p,) for p in parties], "customerKey string")
        return settle(ledger, "customerOffers", rows, known, offer)

    assert run(invoices(("1", "a"), ("2", "b"), ("3", None)), "b") == (1, 1, 1)
    assert [(r.rejectReason, r.rejectKey) for r in ledger.rejects("customerOffers").collect()] == [("customerKey missing", "3")]
    with monkeypatch.context() as broken:
        broken.setattr(runs.Waiting, "acknowledge", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(invoices(("4", "c")), "a", "b")
    assert numbers(ledger.read("customerOffers")) == [1, 2]
    assert run(invoices(("5", "b")), "a", "b", "c") == (2, 0, 0)
    assert numbers(ledger.read("customerOffers")) == [1, 2, 4, 5]
    assert Waiting(ledger, "customerOffers").rows().count() == 0


def test_a_batch_of_which_all_rows_are_taken_is_not_read(spark, ledger, monkeypatch):
    queue = Waiting(ledger, "customerOffers")
    schema = "invoiceNumber string, customerKey string"
    queue.put(spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), ("3", "a")], schema))
    queue.put(spark.createDataFrame([("4", "c"), (None, "c")], schema))
    parties = spark.createDataFrame([("a",), ("b",)], "customerKey string")
    ready = queue.ready(parties)
    assert ready.count() == 4
    read = queue._rows
    monkeypatch.setattr(queue, "_rows", lambda entries: 1 / 0)
    queue.acknowledge(ready)
    monkeypatch.setattr(queue, "_rows", read)
    assert {r["invoiceNumber"] for r in queue.rows().collect()} == {"4", None}
    queue.acknowledge(queue.ready(spark.createDataFrame([("c",)], "customerKey string")))
    assert [r["invoiceNumber"] for r in queue.rows().collect()] == [None]  # as before, not taken without a key


def test_few_keys_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(key_index, "LITERALS", 5)
    rows = spark.range(1_000).select((F.col("id") % 4).cast("string").alias("k"))
    assert key_index.few_keys(rows, "k") == ["0", "1", "2", "3"]
    assert key_index.few_keys(spark.range(6).selectExpr("cast(id AS string) k"), "k") is None
