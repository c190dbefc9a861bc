"""Surrogate ids for appended rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netdays.session import checkpointed

# A generated id is the partition number in the high bits, the row in the low ones.
ROW_BITS = 33


def dense_ids(
    rows: DataFrame,
    column: str,
    first: int = 1,
    order: Sequence[str] = (),
    fixed: bool = False,
) -> DataFrame:
    """Ids ``first, first + 1, ...`` without gaps, optionally in the order of a key.

    The rows are checkpointed, so that their partitions are the same in both
    passes and after a lost executor; ``fixed`` says they come from a checkpoint
    already. Then each partition's row count gives the start of the next one:
    that table has one row per partition, and only it goes through the
    unpartitioned window and the broadcast.
    """
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    if order or not fixed:
        rows = checkpointed(rows)
    numbered = rows.withColumn("_raw", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_raw", ROW_BITS).alias("_part"),
        F.col("_raw").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return numbered.join(F.broadcast(starts), "_part").select(
        (F.lit(first) + F.col("_start") + F.col("_row")).cast("bigint").alias(column),
        *rows.columns,
    )


def stable_id(*key: str):
    """An id made of the natural key alone: the same in every run, with gaps.

    64 bits: fine for parties, too few for tens of billions of offers, which
    take :func:`dense_ids`.
    """
    return F.xxhash64(*key)
