"""Invoices that complete in a stream: split over files, late lines, a replay."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from decimal import Decimal as D

from netdays.catalog import ledgers
from netdays.params import SAMPLE_CUSTOMER
from netdays.sources.ledger import Ledger
from netdays.streaming.lines import line_offer_stream
from netdays.streaming.offers import file_stream

LINE = (
    "invoiceNumber string, lineId bigint, invoiceGrossValue decimal(18,2), invoiceTime timestamp, invoiceDate date,"
    " invoiceCurrencyCode string, customerKey string"
)
IDS = itertools.count()


def line(number, day, gross="10.00", hour=8):
    time = dt.datetime(2024, 3, day, hour)
    return (number, next(IDS), D(gross), time, time.date(), "KES", "k_1" if number else None)


def feed_of(spark, folder, *batches):
    for rows in batches:
        spark.createDataFrame(list(rows), LINE).coalesce(1).write.mode("append").parquet(folder)


def run(spark, ledger, feed, state):
    customers = spark.createDataFrame([("k_1", 5, "30 Days Net")], "customerKey string, customerId bigint, creditTerms string")
    stream = file_stream(spark, feed, spark.createDataFrame([], LINE).schema, files_per_batch=1)
    query = line_offer_stream(stream, customers, ledger, SAMPLE_CUSTOMER, state)
    query.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    return dropped


def credits(ledger):
    return {r.invoiceNumber: r.creditAmount for r in ledger.read("customerOffers").collect()}


def test_split_invoices_complete_and_late_lines_are_rejects(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    feed_of(
        spark, feed,
        [line("1", 1), line("2", 1), line("3", 1, hour=20)],
        [line("2", 1, "5.00"), line("4", 3), line("1", 1, "1.00", hour=7)],
        [line("5", 9), line("4", 3, "2.00", hour=23)],
        [line("5", 9), line("6", 12)],
        # The event time is 12 March: what is complete by 10 March comes too late.
        [line("6", 12, "3.00")],
        [line("7", 4), line("1", 1, "99.00"), line("6", 12, "4.00")],
        [line(None, 20)],
        [line(None, 21)],
        [line("8", 1)],
    )
    state = str(tmp_path / "state")
    dropped = run(spark, ledger, feed, state)
    expected = {"1": D("11.00"), "2": D("15.00"), "3": D("10.00"), "4": D("12.00"), "5": D("20.00"), "6": D("17.00")}
    assert credits(ledger) == expected
    late = {(r.rejectKey, r.rejectReason.split()[0]) for r in ledger.rejects("customerOffers").collect()}
    assert late == {("7", "line"), ("1", "line"), ("8", "line")}
    assert dropped == 3
    # Everything again, as after a lost checkpoint: no offer twice.
    run(spark, ledger, feed, str(tmp_path / "other"))
    assert credits(ledger) == expected and ledger.read("customerOffers").count() == 6
    assert ledger.rejects("customerOffers").count() == 3


def test_lines_of_another_day_than_their_invoice(spark, tmp_path):
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    feed_of(
        spark, feed, [line("1", 1), line("2", 1), line("2", 2)], [line("1", 6, "2.00")], [line(None, 20)], [line(None, 21)]
    )
    run(spark, ledger, feed, str(tmp_path / "state"))
    assert credits(ledger) == {"1": D("10.00"), "2": D("20.00")}
    assert [(r.rejectKey, r.rejectReason) for r in ledger.rejects("customerOffers").collect()] == [("1", "lines came after the offer")]


def test_no_line_is_lost_whatever_the_order(spark, tmp_path):
    chance = random.Random(4)
    feed, ledger = str(tmp_path / "feed"), Ledger(spark, str(tmp_path / "ledger"))
    lines = [line(str(n), 1 + n // 2, f"{chance.randint(1, 9)}.00", hour=chance.randint(0, 23)) for n in range(40) for _ in range(chance.randint(1, 4))]
    order = sorted(lines, key=lambda r: r[3] + dt.timedelta(hours=chance.choice([0, 0, 0, 12, 30, 40, 300])))
    files = [order[i:i + 16] for i in range(0, len(order), 16)]
    feed_of(spark, feed, *files, [line(None, 30)], [line(None, 31)])
    dropped = run(spark, ledger, feed, str(tmp_path / "state"))
    rejects = ledger.rejects("customerOffers").collect()
    # The engine counts lines of one invoice and batch once.
    assert 0 < dropped <= len(rejects)
    late = {r.rejectReason.split()[1] for r in rejects}
    wanted = {}
    for r in lines:
        if str(r[1]) not in late:
            wanted[r[0]] = wanted.get(r[0], 0) + r[2]
    assert credits(ledger) == wanted


def test_feed_batches_of_several_files_stay_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "FEED_ROWS", 300)
    rows = spark.range(3_000)
    sizes = [2_000, 1, 1, 1_000]
    feed = str(tmp_path / "feed")
    files = ledgers._feed([(rows.where(f"id < {n}"), n) for n in sizes], feed)
    assert files == 6
    found = {}
    stream = file_stream(spark, feed, rows.schema, files_per_batch=files)
    stream.writeStream.foreachBatch(lambda batch, number: found.update({number: batch.count()})).option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    assert [found[k] for k in sorted(found)] == sizes
    big = [f for f in (tmp_path / "feed").glob("*.parquet") if spark.read.parquet(str(f)).count() > 1]
    assert len(big) == 12
