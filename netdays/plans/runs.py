"""One incremental run of each side: extract, complete parties, price, append."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from netdays import schemas
from netdays.operators import quality
from netdays.operators.consolidate import consolidate_lines
from netdays.operators.incremental import (
    missing_parties,
    not_yet_offered,
    only_keys,
)
from netdays.params import CustomerParams, SupplierParams
from netdays.plans import payables as payable_plans
from netdays.plans import receivables as receivable_plans
from netdays.session import checkpointed, written
from netdays.sources import payables as payable_sources
from netdays.sources import receivables as receivable_sources
from netdays.sources.ledger import TABLES, Ledger
from netdays.sources.relations import Relations, staged_relations
from netdays.sources.waiting import Waiting


# What a run needs of an invoice line.
LINE_COLUMNS = (*receivable_sources.INVOICE_COLUMNS, *receivable_sources.LINE_ORDER)


@dataclass(frozen=True)
class RunResult:
    watermark: dt.date
    invoices: int
    new_parties: int
    inserted: int
    rejected: int
    waiting: int = 0

    @property
    def message(self) -> str:
        return "inserted" if self.inserted else "already inserted"


def append_checked(
    ledger: Ledger,
    table: str,
    rows: DataFrame,
    id_column: str,
    rules: Mapping[str, Column] | None = None,
    created_at: dt.datetime | None = None,
) -> tuple[int, int]:
    """Append the rows that meet the table's not-null and length rules, keep the others aside.

    ``rules`` are further conditions of a good row, ``created_at`` is what ``createAt`` gets.
    Rows are computed once, into a checkpoint, and counted while they are written there.
    """
    required = [c for c in schemas.required_columns(TABLES[table]) if c != id_column]
    absent = set(required) - set(rows.columns)
    if absent:
        raise ValueError(f"{table} needs {sorted(absent)}")
    if created_at is not None:
        rows = rows.withColumn("createAt", F.lit(created_at).cast(schemas.MOMENT))
    limits = {c: n for c, n in schemas.FIELD_LENGTHS[table].items() if c in rows.columns}
    all_rules = quality.not_null_rules(required) | quality.length_rules(limits) | dict(rules or {})
    counts = Observation()
    marked = quality.with_reject_reason(rows, all_rules).observe(
        counts,
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col("rejectReason").isNotNull()).alias("bad"),
    )
    staged = checkpointed(marked)
    rejected, accepted = counts.get["bad"], counts.get["all"] - counts.get["bad"]
    if rejected:
        ledger.append_rejects(table, quality.rejected(staged))
    if accepted:
        ledger.append(table, quality.accepted(staged), fixed=True)
    return accepted, rejected


def ensure_customers(
    ledger: Ledger, invoices: DataFrame, relations: Relations, created_at: dt.datetime | None = None
) -> int:
    """Load the customers of invoices whose key the ledger does not know.

    Known is judged by site key, so a new site of a known number is loaded too. A customer
    whose number is no number is rejected, and the number kept as text with the reject.
    """
    known = ledger.read("customers")
    missing = written(missing_parties(invoices, known, "customerKey"), "missing-customers")
    if missing.isEmpty():
        return 0
    numbers = only_keys(invoices, missing, "customerKey").select("customerNumber").distinct()
    fetched = only_keys(
        receivable_sources.customer_master(relations, numbers), missing, "customerKey"
    )
    # The ledger holds numbers as such, no location, and no phone of a customer.
    stated = F.col("statedNumber")
    parties = fetched.drop("location", "phone").withColumnRenamed("customerNumber", "statedNumber").withColumn(
        "customerNumber", stated.try_cast("bigint")
    )
    loaded, _ = append_checked(
        ledger, "customers", parties, "customerId",
        {"customerNumber not a number": stated.isNull() | F.col("customerNumber").isNotNull()}, created_at,
    )
    return loaded


def put_aside(
    ledger: Ledger, table: str, odd: DataFrame, reason: str | Column = "creditTerms not readable"
) -> int:
    """Keep invoices that cannot be offered with the rejects; how many there are."""
    count = Observation()
    marked = odd.withColumn("rejectReason", F.lit(reason))
    odd = checkpointed(marked.observe(count, F.count(F.lit(1)).alias("n")))
    if count.get["n"]:
        ledger.append_rejects(table, odd)
    return count.get["n"]


def offer_receivables(
    ledger: Ledger, new: DataFrame, customers: DataFrame, params: CustomerParams,
    created_at: dt.datetime | None = None,
) -> tuple[int, int]:
    """Price and append new invoices, which are read twice and so should be written.

    Those on terms that cannot be read are put aside with the other rejects.
    """
    unreadable = put_aside(ledger, "customerOffers", receivable_plans.unparsable_terms(new, customers))
    offers = receivable_plans.receivable_offers(new, customers, params).withColumn(
        "offerStatus", F.lit(schemas.NOT_SENT)
    )
    inserted, rejected = append_checked(
        ledger, "customerOffers", offers, "customerOfferId", created_at=created_at
    )
    return inserted, rejected + unreadable


def offer_payables(
    ledger: Ledger, new: DataFrame, suppliers: DataFrame, params: SupplierParams,
    created_at: dt.datetime | None = None,
) -> tuple[int, int]:
    """Price and append new canonical invoices, as :func:`offer_receivables` does."""
    unreadable = put_aside(ledger, "supplierPayment", payable_plans.unparsable_terms(new, suppliers))
    nothing = new.select("invoiceUniqueKey").limit(0)
    offers = payable_plans.payable_offers(new, suppliers, nothing, params).withColumn(
        "offerStatus", F.lit(schemas.NOT_SENT)
    )
    inserted, rejected = append_checked(
        ledger, "supplierPayment", offers, "supplierPaymentId", created_at=created_at
    )
    return inserted, rejected + unreadable


def settle(
    ledger: Ledger, table: str, new: DataFrame, parties: DataFrame,
    offer: Callable[[DataFrame, DataFrame], tuple[int, int]],
) -> tuple[int, int, int]:
    """Offer new invoices and those that waited for their party; ``(inserted, rejected, waiting)``.

    ``new`` is a written table of invoices without an offer. Those of unknown parties wait;
    those that name no party are rejects, as nothing they could wait for will come. The queue is
    acknowledged last, so nothing is lost and, by the ledger's keys, nothing offered twice.
    """
    queue = Waiting(ledger, table)
    due, ready = new, None
    if not queue and new.isEmpty():
        return 0, 0, 0
    if queue:
        ready = written(queue.ready(parties), "ready")
        unoffered = not_yet_offered(ready, ledger.held(table, ready, queue.key), queue.key)
        kind = new.schema[queue.key].dataType
        again = unoffered.drop("batch").withColumn(queue.key, F.col(queue.key).try_cast(kind))
        again = again.join(new.select(queue.key), queue.key, "left_anti")
        due = written(new.unionByName(again, allowMissingColumns=True), "due")
    inserted, rejected = offer(due, parties)
    nameless = put_aside(ledger, table, new.where(F.col(queue.party).isNull()), f"{queue.party} missing")
    named = new.where(F.col(queue.party).isNotNull())
    late = queue.put(named.join(parties.select(queue.party), queue.party, "left_anti"))
    if ready is not None:
        queue.acknowledge(ready)
    return inserted, rejected + nameless, late


def settle_receivables(
    ledger: Ledger, new: DataFrame, customers: DataFrame, params: CustomerParams,
    created_at: dt.datetime | None = None,
) -> tuple[int, int, int]:
    return settle(
        ledger, "customerOffers", new, customers,
        lambda due, known: offer_receivables(ledger, due, known, params, created_at),
    )


def settle_payables(
    ledger: Ledger, new: DataFrame, suppliers: DataFrame, params: SupplierParams,
    created_at: dt.datetime | None = None,
) -> tuple[int, int, int]:
    return settle(
        ledger, "supplierPayment", new, suppliers,
        lambda due, known: offer_payables(ledger, due, known, params, created_at),
    )


def run_receivables(
    ledger: Ledger, relations: Relations, params: CustomerParams, as_of: dt.date,
    created_at: dt.datetime | None = None,
) -> RunResult:
    ledger.create()
    relations = staged_relations(relations, receivable_sources.STAGED)
    since = ledger.watermark("customerOffers", as_of)
    # The ledger is asked about the numbers alone; lines of invoices it holds, mostly those of the
    # watermark's day, are left out before they are summed. The lines are fetched once.
    lines = written(receivable_sources.invoice_lines(relations, since).select(*LINE_COLUMNS), "lines")
    numbers = written(lines.select("invoiceNumber").where("invoiceNumber is not null").distinct(), "numbers")
    held = written(ledger.held("customerOffers", numbers, "invoiceNumber"), "held")
    fresh = not_yet_offered(lines, held, "invoiceNumber")
    new = written(consolidate_lines(fresh, receivable_sources.LINE_ORDER), "new-receivables")
    new_parties = ensure_customers(ledger, new, relations, created_at)
    inserted, rejected, waiting = settle_receivables(ledger, new, ledger.read("customers"), params, created_at)
    return RunResult(since, numbers.count(), new_parties, inserted, rejected, waiting)


def ensure_suppliers(
    ledger: Ledger, invoices: DataFrame, relations: Relations, created_at: dt.datetime | None = None
) -> int:
    known = ledger.read("suppliers")
    missing = written(missing_parties(invoices, known, "vendorId"), "missing-suppliers")
    if missing.isEmpty():
        return 0
    fetched = payable_sources.supplier_parties(relations, missing).withColumnRenamed("supplierName", "name")
    loaded, _ = append_checked(ledger, "suppliers", fetched, "supplierId", created_at=created_at)
    return loaded


def run_payables(
    ledger: Ledger,
    relations: Relations,
    params: SupplierParams,
    as_of: dt.date,
    org_id: int | None = None,
    created_at: dt.datetime | None = None,
) -> RunResult:
    """The extract is windowed by GL date, so the watermark is the last GL date."""
    ledger.create()
    since = ledger.watermark("supplierPayment", as_of, "glDate")
    extract = payable_sources.invoice_extract(
        relations, since, as_of, org_id, payable_sources.OFFER_INPUT
    )
    invoices = written(payable_plans.canonical_invoices(extract, with_gl_date=True), "payables")
    new_parties = ensure_suppliers(ledger, invoices, relations, created_at)

    held = ledger.held("supplierPayment", invoices, "invoiceUniqueKey")
    new = written(not_yet_offered(invoices, held, "invoiceUniqueKey"), "new-payables")
    inserted, rejected, waiting = settle_payables(ledger, new, ledger.read("suppliers"), params, created_at)
    return RunResult(since, invoices.count(), new_parties, inserted, rejected, waiting)
