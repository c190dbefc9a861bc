"""Invoices whose party is not known yet: a queue under the ledger's commit log.

What waits is appended once and stays where it is; when a party has come, its invoices are
handed out, offered, and only then acknowledged. A run that dies in between hands
them out again, and the keys of the ledger keep them from being offered twice. An
acknowledgement rewrites the batches it takes rows from and no others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from netdays import schemas
from netdays.sources.commits import Entry
from netdays.sources.key_index import KEYS
from netdays.sources.ledger import Ledger, fit

_GROSS = StructField("invoiceGrossValue", schemas.CREDIT)


def _texts(*names: str) -> list[StructField]:
    return [StructField(n, schemas.TEXT) for n in names]


SCHEMAS = {
    "customerOffers": StructType(
        [*_texts("invoiceNumber", "customerKey", "invoiceCurrencyCode"), StructField("invoiceDate", schemas.DAY), _GROSS]
    ),
    "supplierPayment": StructType(
        [
            *_texts("invoiceUniqueKey", "invoiceNumber"), StructField("vendorId", schemas.LONG),
            StructField("invoiceDate", schemas.DAY), StructField("glDate", schemas.DAY), _GROSS,
        ]
    ),
}
PARTIES = {"customerOffers": "customerKey", "supplierPayment": "vendorId"}

# Batches that lie side by side before an acknowledgement packs them all.
BATCHES = 32


class Waiting:
    """The queue of one offer table. Rows come back with the ``batch`` they lie in."""

    def __init__(self, ledger: Ledger, table: str):
        self.ledger = ledger
        self.table = table
        self.name = f"{table}.waiting"
        self.key = KEYS[table]
        self.party = PARTIES[table]
        self.schema = SCHEMAS[table]

    def _rows(self, entries: list[Entry]) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField("batch", schemas.TEXT)])
        if not entries:
            return fit(self.ledger.spark.range(0), schema)
        top = f"{self.ledger.root}/{self.name}"
        reader = self.ledger.spark.read.schema(schema).option("basePath", top)
        return reader.parquet(*[f"{top}/batch={e.batch}" for e in entries])

    def rows(self) -> DataFrame:
        return self._rows(self.ledger.entries(self.name))

    def __bool__(self) -> bool:
        return bool(self.ledger.entries(self.name))

    def _batch(self, rows: DataFrame) -> list[Entry]:
        batch = uuid.uuid4().hex
        path = f"{self.ledger.root}/{self.name}/batch={batch}"
        fit(rows, self.schema).hint("rebalance").write.parquet(path)
        count = self.ledger.spark.read.schema(self.schema).parquet(path).count()
        return [Entry(self.name, batch, None, count)] if count else []

    def put(self, invoices: DataFrame) -> int:
        """Let invoices wait, those that wait already left out; how many came in."""
        before = self.ledger.version
        new = fit(invoices, self.schema)
        if self:
            new = new.join(self.rows().select(self.key), self.key, "left_anti")
        added = self._batch(new)
        if added:
            self.ledger.log.publish((*self.ledger.log.entries(before), *added), before)
        return sum(e.rows for e in added)

    def ready(self, parties: DataFrame) -> DataFrame:
        """Waiting invoices whose party is among ``parties``."""
        return self.rows().join(parties.select(self.party), self.party, "left_semi")

    def acknowledge(self, done: DataFrame) -> None:
        """Take rows out that :meth:`ready` gave and that were offered or set aside."""
        before = self.ledger.version
        live = self.ledger.log.entries(before)
        mine = [e for e in live if e.table == self.name]
        taken = {row[0]: row[1] for row in done.groupBy("batch").agg(F.count(self.key)).collect()}
        if not taken:
            return
        touched = mine if len(mine) > BATCHES else [e for e in mine if e.batch in taken]
        # A batch of which all rows are taken leaves nothing to be read.
        rest = [e for e in touched if taken.get(e.batch) != e.rows]
        left: list[Entry] = []
        if rest:
            rows = self._rows(rest).join(done.select(self.key, "batch"), [self.key, "batch"], "left_anti")
            left = self._batch(rows)
        self.ledger.log.publish((*[e for e in live if e not in touched], *left), before)
