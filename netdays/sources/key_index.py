"""Keys of offered invoices beside the ledger, so that a load is checked without its offers.

Each append writes its keys sorted, in small row groups with a Bloom filter each. A small
load asks with its keys as literals, which reach the scan: row groups that hold none of
them are skipped. A large load joins, reading two narrow columns in place of the offers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from netdays import schemas
from netdays.operators.incremental import offered_among
from netdays.sources.commits import Entry

if TYPE_CHECKING:
    from netdays.sources.ledger import Ledger

KEYS = {"customerOffers": "invoiceNumber", "supplierPayment": "invoiceUniqueKey"}
SCHEMA = StructType([StructField("key", schemas.TEXT), StructField("invoiceMonth", schemas.DAY)])

# Loads of up to so many different keys ask with literals; the answer is the same either way.
LITERALS = 1_000
ROW_GROUP_BYTES = 1 << 20


def name(table: str) -> str:
    return f"{table}.keys"


def _write(rows: DataFrame, ledger: Ledger, table: str) -> Entry:
    """A new folder of keys in the order of the key over all files."""
    batch = uuid.uuid4().hex
    path = f"{ledger.root}/{name(table)}/batch={batch}"
    (
        rows.repartitionByRange("key").sortWithinPartitions("key").write
        .option("parquet.bloom.filter.enabled#key", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )
    return Entry(name(table), batch, None, ledger.spark.read.schema(SCHEMA).parquet(path).count())


def write_keys(ledger: Ledger, table: str, added: Sequence[Entry]) -> Entry:
    """The keys of folders that were just written."""
    rows = ledger._live(table, added, ledger.stored_schema(table))
    return _write(rows.select(F.col(KEYS[table]).alias("key"), "invoiceMonth"), ledger, table)


def pack_keys(ledger: Ledger, table: str, entries: Sequence[Entry]) -> Entry:
    """The keys of several folders as one."""
    return _write(ledger._live(name(table), entries, SCHEMA), ledger, table)


def few_keys(rows: DataFrame, key: str) -> list[str] | None:
    """The distinct keys of a small load; none of a large one, or where keys are not text.

    The first rows tell most loads apart: where so many differ, no key of the others is shuffled.
    """
    if not isinstance(rows.schema[key].dataType, StringType):
        return None
    keys = rows.select(key).where(F.col(key).isNotNull())
    first = keys.limit(2 * LITERALS).collect()
    found = {row[0] for row in first}
    if len(found) <= LITERALS and len(first) == 2 * LITERALS:
        found = {row[0] for row in keys.distinct().limit(LITERALS + 1).collect()}
    return sorted(found) if len(found) <= LITERALS else None


def rows_held(index: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of the index whose key is among those of ``rows``."""
    few = few_keys(rows, key)
    if few is not None:
        return index.where(F.col("key").isin(few))
    kind = rows.schema[key].dataType
    wanted = rows.select(F.col(key).alias("wanted"))
    return index.join(wanted, F.col("key").try_cast(kind) == F.col("wanted"), "left_semi")


def held(index: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keys of the index that occur among ``rows``, in a column named like theirs."""
    few = few_keys(rows, key)
    if few is not None:
        return index.where(F.col("key").isin(few)).select(F.col("key").alias(key))
    return offered_among(rows, index.select(F.col("key").alias(key)), key)
