"""Invoices from a stream of lines, each when all its lines should have come.

Lines of an invoice may lie in several files and come in any order. They are summed as they
come, in state kept by the stream; the invoices of a span of event time, such as a day, are
complete when the stream has passed its end by ``delay``, and then go to the same offers as a
batch run's. A line that comes later is kept with the rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netdays import schemas
from netdays.operators.consolidate import first_by
from netdays.operators.incremental import not_yet_offered, offered_among
from netdays.params import CustomerParams
from netdays.plans.runs import put_aside, settle_receivables
from netdays.session import written
from netdays.sources.ledger import Ledger
from netdays.sources.waiting import Waiting
from netdays.streaming.offers import Complete, Parties, _now, _start

FIRSTS = ("invoiceDate", "invoiceCurrencyCode", "customerKey")


def completed_invoices(
    lines: DataFrame,
    time: str,
    delay: str,
    span: str,
    order: Sequence[str] = ("lineId",),
    key: str = "invoiceNumber",
    amount: str = "invoiceGrossValue",
    firsts: Sequence[str] = FIRSTS,
) -> DataFrame:
    """Invoices of a line stream, each once per span, in append mode.

    The time of all lines of an invoice should lie in one span, as their invoice date does; lines
    up to ``delay`` older than the newest are waited for. State is one sum and one value
    per column and open invoice; sums combine before the shuffle.
    """
    total = F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(20,2)").alias(amount)
    return (
        lines.withWatermark(time, delay)
        .groupBy(key, F.window(time, span))
        .agg(total, *[first_by(c, order) for c in firsts])
        .drop("window")
    )


class EventTimes:
    """The newest event time after each batch, kept beside the checkpoint.

    A batch that runs again finds and writes the same values.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark = spark
        self.path = f"{checkpoint}-times"
        self.schema = "batch bigint, newest timestamp"

    def until(self, number: int):
        """The newest time of all batches up to a number; none before the first."""
        if number < 0:
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{number}").head()[1]

    def keep(self, number: int, newest) -> None:
        known = [t for t in (self.until(number - 1), newest) if t is not None]
        row = [(number, max(known, default=None))]
        self.spark.createDataFrame(row, self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{number}")


def late_lines(lines: DataFrame, time: str, newest, delay: str, span: str) -> DataFrame:
    """Lines of a span that was complete when the newest event time was ``newest``."""
    if newest is None:
        return lines.limit(0)
    limit = F.lit(newest) - F.expr(f"INTERVAL {delay}")
    return lines.withColumn("window", F.window(time, span)).where(F.col("window.end") <= limit).drop("window")


def _in_one_piece(pieces: DataFrame) -> DataFrame:
    """One row per number, should lines of an invoice lie in two spans that end together."""
    total = F.sum("invoiceGrossValue").cast("decimal(20,2)").alias("invoiceGrossValue")
    return pieces.groupBy("invoiceNumber").agg(total, *[first_by(c, ["invoiceDate"]) for c in FIRSTS])


def _other_amounts(ledger: Ledger, pieces: DataFrame) -> DataFrame:
    """Completed invoices that have an offer over another amount; a replay has the same one."""
    offers = ledger.read("customerOffers").select(F.col("invoiceNumber").alias("offered"), "creditAmount")
    offers = offers.join(pieces.select("invoiceNumber"), F.col("offered") == F.col("invoiceNumber"), "left_semi")
    return pieces.join(offers, F.col("offered") == F.col("invoiceNumber")).where(
        "creditAmount <> invoiceGrossValue"
    ).drop("offered", "creditAmount")


def line_offer_stream(
    lines: DataFrame,
    customers: Parties,
    ledger: Ledger,
    params: CustomerParams,
    checkpoint: str,
    time: str = "invoiceTime",
    delay: str = "2 days",
    span: str = "1 day",
    offered_elsewhere: DataFrame | None = None,
    every: str | None = None,
    complete: Complete | None = None,
) -> StreamingQuery:
    """Append offers for customer invoices whose lines arrive one by one.

    ``lines`` has invoiceNumber, lineId, invoiceGrossValue, the event time and the columns of
    ``FIRSTS``. Lines without a number only move the event time on, so a feed that falls silent
    can send such a line to have its last invoices completed. Where lines of an invoice lie
    in two spans, the first to be complete is offered, and the rest is a reject. The other
    parameters are those of :func:`netdays.streaming.offers.customer_offer_stream`.

    The engine tests lateness against the event time two batches back, that of the batch
    whose end was known when the one before this was planned; so does :func:`late_lines`.
    """
    ledger.create()
    times = EventTimes(ledger.spark, checkpoint)
    line = ["invoiceNumber", "lineId", "invoiceGrossValue", time]
    invoices = completed_invoices(lines, time, delay, span).withColumn("kind", F.lit("invoice"))
    both = invoices.unionByName(lines.select(*line).withColumn("kind", F.lit("line")), allowMissingColumns=True)

    def keep_late(came: DataFrame, known) -> None:
        late = late_lines(came, time, known, delay, span).where(F.col("invoiceNumber").isNotNull())
        if late.isEmpty():
            return
        rows = late.groupBy("invoiceNumber", "lineId").agg(
            F.sum("invoiceGrossValue").alias("invoiceGrossValue"), F.max(time).alias(time)
        )
        reason = F.concat(F.lit("line "), F.coalesce(F.col("lineId").cast("string"), F.lit("?")), F.lit(" came late"))
        put_aside(ledger, "customerOffers", rows, reason)

    def offer(completed: DataFrame) -> None:
        again = written(
            completed.join(ledger.held("customerOffers", completed, "invoiceNumber"), "invoiceNumber", "left_semi"), "again"
        )
        if not again.isEmpty():
            put_aside(ledger, "customerOffers", _other_amounts(ledger, again), "lines came after the offer")
        new = not_yet_offered(completed, again, "invoiceNumber")
        if offered_elsewhere is not None:
            new = not_yet_offered(new, offered_among(new, offered_elsewhere, "invoiceNumber"), "invoiceNumber")
        new = written(new, "new-batch")
        if complete is not None:
            complete(ledger, new)
        settle_receivables(ledger, new, _now(customers), params)

    def append(batch: DataFrame, number: int) -> None:
        # Of the lines, only those that may be late are written, and the newest time of all is observed.
        known, newest = times.until(number - 2), Observation()
        is_line = F.col("kind") == "line"
        needed = ~is_line if known is None else ~is_line | (F.col(time) < F.lit(known) - F.expr(f"INTERVAL {delay}"))
        seen = batch.observe(newest, F.max(F.when(is_line, F.col(time))).alias("newest"))
        both = written(seen.where(needed), "batch")
        keep_late(both.where(is_line).select(*line), known)
        pieces = both.where("kind = 'invoice' and invoiceNumber is not null")
        completed = written(_in_one_piece(pieces), "completed")
        # Most batches complete nothing.
        if Waiting(ledger, "customerOffers") or not completed.isEmpty():
            offer(completed)
        times.keep(number, newest.get["newest"])

    return _start(both, append, checkpoint, every)
