"""Discount tiers by term days."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.functions.money import literal
from netdays.params import CustomerParams, SupplierParams


def _looked_up(days: Column, values: Mapping[int, Column], default: Column) -> Column:
    """A value per term out of a constant map, whatever the number of tiers: no join."""
    if not values:
        return default
    entries = [x for term, value in sorted(values.items()) for x in (F.lit(term), value)]
    return F.coalesce(F.try_element_at(F.create_map(*entries), days), default)


def early_days(days: Column, params: CustomerParams | SupplierParams) -> Column:
    """Days saved for a term, 0 without a tier."""
    if isinstance(params, SupplierParams):
        values = {k: F.lit(t.early_days) for k, t in params.tiers.items()}
    else:
        values = {k: F.lit(v) for k, v in params.tiers.items()}
    return _looked_up(days, values, F.lit(0))


def tier_percent(days: Column, params: SupplierParams) -> Column:
    """Supplier discount in percent, 0 without a tier."""
    values = {k: literal(t.percent).cast("decimal(7,4)") for k, t in params.tiers.items()}
    return _looked_up(days, values, F.lit(0).cast("decimal(7,4)"))


def tier_table(spark: SparkSession, params: CustomerParams | SupplierParams) -> DataFrame:
    """Tiers as rows ``(termDays, earlyDays, percent)``."""
    if isinstance(params, SupplierParams):
        rows = [(k, t.early_days, t.percent) for k, t in params.tiers.items()]
    else:
        rows = [(k, v, 0) for k, v in params.tiers.items()]
    cells = [
        F.struct(
            F.lit(term).alias("termDays"),
            F.lit(early).alias("earlyDays"),
            literal(percent).cast("decimal(7,4)").alias("percent"),
        )
        for term, early, percent in rows
    ]
    empty = F.array().cast("array<struct<termDays:int,earlyDays:int,percent:decimal(7,4)>>")
    return spark.range(1).select(F.inline(F.array(*cells) if cells else empty))


def join_tiers(rows: DataFrame, tiers: DataFrame, days: str, strict: bool = False) -> DataFrame:
    """Tier columns by term days: default 0, or with ``strict`` only known terms.

    No hint: the optimizer knows the size of a :func:`tier_table` and broadcasts
    it; a tier table from elsewhere is broadcast only if its size allows it.
    """
    keyed = tiers.withColumnRenamed("termDays", days)
    if strict:
        return rows.join(keyed, days, "inner")
    return rows.join(keyed, days, "left").withColumns(
        {
            "earlyDays": F.coalesce("earlyDays", F.lit(0)),
            "percent": F.coalesce("percent", F.lit(0).cast("decimal(7,4)")),
        }
    )
