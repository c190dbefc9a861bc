"""The offer ledger: four parquet tables in batches, offers by invoice month, under a commit log."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from netdays import schemas
from netdays.functions.dates import lookback_start
from netdays.operators.ids import dense_ids
from netdays.operators.incremental import offered_among
from netdays.operators.updates import update_column
from netdays.sources import key_index
from netdays.sources.commits import CommitLog, ConcurrentCommit, Entry

TABLES = {
    "customers": schemas.CUSTOMERS,
    "customerOffers": schemas.CUSTOMER_OFFERS,
    "suppliers": schemas.SUPPLIERS,
    "supplierPayment": schemas.SUPPLIER_PAYMENTS,
}
IDS = {
    "customers": "customerId",
    "customerOffers": "customerOfferId",
    "suppliers": "supplierId",
    "supplierPayment": "supplierPaymentId",
}
# What a row is known by where it was rejected and has no id.
NATURAL_KEYS = {
    "customers": "customerKey",
    "customerOffers": "invoiceNumber",
    "suppliers": "vendorId",
    "supplierPayment": "invoiceUniqueKey",
}
BY_MONTH = ("customerOffers", "supplierPayment")
REJECTS = StructType(
    [StructField(c, schemas.TEXT) for c in ("rejectReason", "rejectKey", "row")]
)
MONTH = "invoiceMonth"


def fit(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a schema in its order and types; absent ones are null."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


class Ledger:
    """Tables under ``root``, or where ``locations`` says, as after a snapshot.

    What is live is read from the commit log, in its newest ``version`` unless one is given.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        locations: Mapping[str, str] | None = None,
        version: int | None = None,
    ):
        self.spark = spark
        self.root = root
        self.locations = dict(locations or {})
        self.log = CommitLog(spark, f"{root}/commits")
        self._version = version

    def path(self, table: str) -> str:
        return self.locations.get(table, f"{self.root}/{table}")

    def stored_schema(self, table: str) -> StructType:
        """Files do not enforce "not null"; that is checked before the append."""
        fields = [StructField(f.name, f.dataType) for f in TABLES[table].fields]
        if table in BY_MONTH:
            fields.append(StructField(MONTH, schemas.DAY))
        return StructType(fields)

    def create(self) -> None:
        """Empty tables where there are none."""
        if self.log.latest() is None:
            try:
                self.log.publish((), None)
            except ConcurrentCommit:
                pass  # created by another writer meanwhile
        for table in TABLES:
            fit(self.spark.range(0), REJECTS).write.mode("ignore").parquet(self.rejects_path(table))

    @property
    def version(self) -> int | None:
        """The version that is read; none before the ledger is created."""
        return self.log.latest() if self._version is None else self._version

    def at(self, version: int) -> Ledger:
        """The ledger as it was when a version was published."""
        return Ledger(self.spark, self.root, self.locations, version)

    def entries(self, table: str) -> list[Entry]:
        version = self.version
        return [] if version is None else [e for e in self.log.entries(version) if e.table == table]

    def _live(self, name: str, entries: Sequence[Entry], schema: StructType) -> DataFrame:
        """The rows of some folders."""
        if not entries:
            return fit(self.spark.range(0), schema)
        top = f"{self.root}/{name}"
        month = lambda e: "" if e.month is None else f"/{MONTH}={e.month.isoformat()}"
        paths = [f"{top}/batch={e.batch}{month(e)}" for e in entries]
        stored = StructType([*schema.fields, StructField("batch", schemas.TEXT)])
        return self.spark.read.schema(stored).option("basePath", top).parquet(*paths).drop("batch")

    def read(self, table: str) -> DataFrame:
        if table in self.locations:
            return self.spark.read.schema(self.stored_schema(table)).parquet(self.path(table))
        return self._live(table, self.entries(table), self.stored_schema(table))

    def last_id(self, table: str) -> int:
        if table in self.locations:
            return self.read(table).agg(F.coalesce(F.max(IDS[table]), F.lit(0))).head()[0]
        return max((e.last_id for e in self.entries(table) if e.last_id is not None), default=0)

    def _partitioned(self, rows: DataFrame, table: str, path: str) -> None:
        """Write rows, a folder per month. The rebalance keeps the files of a small month few
        and cuts those of a large one, so that no task writes a whole hot month."""
        if table in BY_MONTH:
            month = F.trunc("invoiceDate", "month")
            rows.withColumn(MONTH, month).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(path)
        else:
            rows.hint("rebalance").write.parquet(path)

    def _batch(self, table: str, rows: DataFrame) -> list[Entry]:
        """A new folder of rows that have ids, not yet published."""
        batch = uuid.uuid4().hex
        path = f"{self.root}/{table}/batch={batch}"
        self._partitioned(rows.select(*TABLES[table].names), table, path)
        columns = TABLES[table].names
        largest = lambda c: F.max(c) if c in columns else F.lit(None).cast("date")
        month = F.col(MONTH) if table in BY_MONTH else F.lit(None).cast("date")
        # A narrow scan of the new folder alone: one row per month comes back.
        stats = (
            self.spark.read.schema(self.stored_schema(table)).parquet(path)
            .groupBy(month.alias("month"))
            .agg(F.count(F.lit(1)), F.max(IDS[table]), largest("invoiceDate"), largest("glDate"))
        )
        return [Entry(table, batch, *row) for row in stats.collect()]

    def append(self, table: str, rows: DataFrame, fixed: bool = False) -> None:
        """Append rows with new ids. Rows must have passed the not-null rules.

        ``fixed`` rows come from a checkpoint, which numbers them without another. Data and keys
        are written first and then published together, so a run that dies in between leaves
        the ledger as it was. :class:`ConcurrentCommit` tells that another writer was faster.
        """
        before = self.version
        live = () if before is None else self.log.entries(before)
        identified = fit(
            dense_ids(rows, IDS[table], first=self.last_id(table) + 1, fixed=fixed), TABLES[table]
        )
        added = self._batch(table, identified)
        if not added:
            return
        if table in BY_MONTH:
            added = [*added, key_index.write_keys(self, table, added)]
        self.log.publish((*live, *added), before)

    def keys(self, table: str) -> DataFrame:
        """``(key, invoiceMonth)`` of every offer, each batch sorted by key."""
        name = key_index.name(table)
        return self._live(name, self.entries(name), key_index.SCHEMA)

    def held(self, table: str, invoices: DataFrame, key: str) -> DataFrame:
        """Keys of the ledger that occur among the invoices, from the key index."""
        if table in self.locations:
            return offered_among(invoices, self.read(table), key)
        return key_index.held(self.keys(table), invoices, key)

    def update(
        self, table: str, updates: DataFrame, key: str, column: str, order: str | None = None
    ) -> list[dt.date]:
        """Publish the offers with ``column`` replaced, as :func:`update_column` does.

        Only months that hold an updated key are read and written anew; their list, which comes
        from the key index, is returned. A failed or concurrent update changes nothing.
        """
        before = self.version
        live = self.log.entries(before)
        months = sorted(
            row[0] for row in key_index.rows_held(self.keys(table), updates, key).select(MONTH).distinct().collect()
        )
        touched = [e for e in live if e.table == table and e.month in months]
        if not touched:
            return []
        rows = self._live(table, touched, self.stored_schema(table))
        added = self._batch(table, update_column(rows, updates, key, column, order))
        self.log.publish((*[e for e in live if e not in touched], *added), before)
        return months

    def compact(self, table: str, folders: int = 2) -> list[dt.date | None]:
        """Pack months that lie in ``folders`` or more batches into one each, and so their keys.

        Files get the size that adaptive execution aims at (advisoryPartitionSizeInBytes). The
        packed months come back; older versions keep their files.
        """
        before = self.version
        live = self.log.entries(before)
        by_month: dict = {}
        for entry in live:
            if entry.table == table:
                by_month.setdefault(entry.month, []).append(entry)
        crowded = [e for some in by_month.values() if len(some) >= folders for e in some]
        added = self._batch(table, self._live(table, crowded, self.stored_schema(table))) if crowded else []
        keys = [e for e in live if e.table == key_index.name(table)]
        if len(keys) >= folders:
            added = [*added, key_index.pack_keys(self, table, keys)]
            crowded = [*crowded, *keys]
        if added:
            self.log.publish((*[e for e in live if e not in crowded], *added), before)
        return sorted(({e.month for e in added if e.table == table}), key=str)

    def rejects_path(self, table: str) -> str:
        return f"{self.root}/rejects/{table}"

    def rejects(self, table: str) -> DataFrame:
        return self.spark.read.schema(REJECTS).parquet(self.rejects_path(table))

    def append_rejects(self, table: str, rows: DataFrame) -> None:
        """Rows with a ``rejectReason`` as JSON text; those kept before are left out."""
        body = F.to_json(F.struct(*[c for c in rows.columns if c != "rejectReason"]))
        texts = rows.select(
            "rejectReason",
            F.col(NATURAL_KEYS[table]).cast("string").alias("rejectKey"),
            body.alias("row"),
        )
        kept = self.rejects(table).select("rejectReason", "rejectKey")
        new = texts.join(kept, ["rejectReason", "rejectKey"], "left_anti")
        new.select(*REJECTS.names).write.mode("append").parquet(self.rejects_path(table))

    def write_snapshot(self, table: str, rows: DataFrame, path: str) -> Ledger:
        """Write a copy of a table to a fresh path; the new ledger reads it there."""
        partitions = [MONTH] if table in BY_MONTH else []
        rows.write.mode("errorifexists").partitionBy(*partitions).parquet(path)
        return Ledger(self.spark, self.root, self.locations | {table: path}, self._version)

    def watermark(self, table: str, as_of: dt.date, column: str = "invoiceDate") -> dt.date:
        """Last date in ``column``, else two months before ``as_of``; no offer is read for it."""
        if table in self.locations:
            last = self.read(table).agg(F.max(column)).head()[0]
        else:
            dates = {"invoiceDate": "last_invoice_date", "glDate": "last_gl_date"}[column]
            known = (getattr(e, dates) for e in self.entries(table))
            last = max((d for d in known if d is not None), default=None)
        if last is not None:
            return last
        return self.spark.range(1).select(lookback_start(F.lit(as_of))).head()[0]
