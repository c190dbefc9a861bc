"""Keyed updates of a table that has no MERGE: a new snapshot of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_column(
    table: DataFrame, updates: DataFrame, key: str, column: str, order: str | None = None
) -> DataFrame:
    """``column`` replaced where ``updates(key, column)`` has a value for the key.

    Of several values for one key the last by ``order`` counts (of equal places the
    largest), so no row is repeated. Without an order the largest one counts.
    """
    place = F.struct(F.col(order) if order else F.lit(0), column)
    new = (
        updates.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
        .select(F.col(key).try_cast(table.schema[key].dataType).alias(key), place.alias("_place"))
        .groupBy(key)
        .agg(F.max("_place")[column].alias("_new"))
    )
    return table.join(new, key, "left").select(
        *[F.coalesce("_new", column).alias(c) if c == column else F.col(c) for c in table.columns]
    )


def updates_without_row(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates whose key the table does not hold."""
    keys = table.select(F.col(key).try_cast(updates.schema[key].dataType).alias(key))
    return updates.join(keys, key, "left_anti")
