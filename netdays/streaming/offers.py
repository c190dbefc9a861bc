"""Offers fed continuously: each micro-batch runs the batch plan.

Exactly once by invoice key: a batch leaves out what the ledger already
holds, so a batch that is replayed after a failure adds nothing twice.

Nothing is lost either: invoices whose party isn't known yet wait in the ledger's queue,
which streams and runs drain alike, and are offered with the first batch or run after
the party has come.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from netdays.operators.incremental import not_yet_offered, offered_among
from netdays.params import CustomerParams, SupplierParams
from netdays.plans.payables import canonical_invoices
from netdays.plans.runs import settle_payables, settle_receivables
from netdays.session import written
from netdays.sources.ledger import Ledger


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_repeats(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other.

    Only for feeds that are in time order up to ``delay``: older rows count as
    late and are dropped. Without it the ledger alone keeps keys single.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def _start(
    stream: DataFrame,
    append: Callable[[DataFrame, int], object],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    """Run ``append`` on each micro-batch.

    With ``every``, such as ``"5 minutes"``, the query runs on, one batch per
    interval; without it, it stops when all that is there has been read.
    """
    writer = stream.writeStream.foreachBatch(append).option(
        "checkpointLocation", checkpoint
    )
    if every is not None:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


Parties = DataFrame | Callable[[], DataFrame]
Complete = Callable[[Ledger, DataFrame], object]


def _now(parties: Parties) -> DataFrame:
    return parties() if callable(parties) else parties


def _held(ledger: Ledger, table: str, new: DataFrame, elsewhere: DataFrame | None, key: str) -> list[DataFrame]:
    """Keys of the batch that have an offer, in the ledger and elsewhere."""
    found = [ledger.held(table, new, key)]
    return found if elsewhere is None else [*found, offered_among(new, elsewhere, key)]


def customer_offer_stream(
    headers: DataFrame,
    to_invoices: Callable[[DataFrame], DataFrame],
    customers: Parties,
    ledger: Ledger,
    params: CustomerParams,
    checkpoint: str,
    offered_elsewhere: DataFrame | None = None,
    every: str | None = None,
    complete: Complete | None = None,
) -> StreamingQuery:
    """Append offers for arriving customer invoices.

    ``to_invoices`` consolidates a batch: its own lines, or its headers with
    lines from elsewhere, of which it should read only those of the batch. A
    batch is written before it is used, so it is computed once and its size is
    known to the joins. All lines of an invoice must be there when its header comes; where
    lines come in any order, :func:`netdays.streaming.lines.line_offer_stream` waits for them.

    ``customers`` may be a function, such as one that reads the ledger, and is then
    asked in each batch; ``complete``, such as ``ensure_customers``, loads parties of
    the batch's invoices first.
    """
    ledger.create()

    def append(batch: DataFrame, number: int) -> None:
        new = written(batch.distinct(), "batch")
        for held in _held(ledger, "customerOffers", new, offered_elsewhere, "invoiceNumber"):
            new = not_yet_offered(new, held, "invoiceNumber")
        invoices = written(to_invoices(new), "new-batch")
        if complete is not None:
            complete(ledger, invoices)
        settle_receivables(ledger, invoices, _now(customers), params)

    return _start(headers, append, checkpoint, every)


def supplier_offer_stream(
    extract: DataFrame,
    suppliers: Parties,
    ledger: Ledger,
    params: SupplierParams,
    checkpoint: str,
    offered_elsewhere: DataFrame | None = None,
    every: str | None = None,
    complete: Complete | None = None,
) -> StreamingQuery:
    """Append offers for arriving supplier invoices, shaped like the ERP extract.

    ``suppliers`` and ``complete`` are as for customers.
    """
    ledger.create()

    def append(batch: DataFrame, number: int) -> None:
        new = written(canonical_invoices(batch, with_gl_date=True), "batch")
        for held in _held(ledger, "supplierPayment", new, offered_elsewhere, "invoiceUniqueKey"):
            new = not_yet_offered(new, held, "invoiceUniqueKey")
        new = written(new, "new-batch")
        if complete is not None:
            complete(ledger, new)
        settle_payables(ledger, new, _now(suppliers), params)

    return _start(extract, append, checkpoint, every)
