"""At-most-one-row look-ups: unit cost, descriptions, first match, flags, pivots.

Each is a left join to one row per key. The one row is made by an aggregate with
constant-size state, so a key with very many candidates is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netdays.operators.joins import spread_left_join


def first_match(
    candidates: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One candidate row per key: the first by ``order``, its columns kept together."""
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (
        candidates.groupBy(*keys)
        .agg(F.min_by(F.struct(*columns), rank).alias("match"))
        .select(*keys, *[F.col(f"match.{c}").alias(c) for c in columns])
    )


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Left join to a table that holds one row per key."""
    return rows.join(table, keys, "left")


def _guarded(value: Column, repeated: Column, on_repeat: str, message: Column) -> Column:
    if on_repeat == "raise":
        return F.when(repeated, F.raise_error(message)).otherwise(value)
    if on_repeat == "reject":
        return F.when(~repeated, value)
    raise ValueError("on_repeat must be raise or reject")


def _message(keys: Sequence[str], what: str) -> Column:
    key = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return F.concat(F.lit(f"several values of {what} for {', '.join(keys)} = "), key)


def single_row(
    table: DataFrame, keys: Sequence[str], columns: Sequence[str], on_repeat: str = "raise", flag: str | None = None
) -> DataFrame:
    """One row per key of a table that should hold one; rows that are equal count as one.

    A key whose rows differ in a column fails the job that reads it (``raise``) or gives nulls
    (``reject``); ``flag`` names a column that tells which keys those are. The state of a key is two
    values and a count per column, so a key may have any number of rows.
    """
    one = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max), ("filled", F.count))],
    )
    differs = [
        (F.col(f"_low_{c}") != F.col(f"_high_{c}")) | ((F.col(f"_filled_{c}") > 0) & (F.col(f"_filled_{c}") < F.col("_rows")))
        for c in columns
    ]
    repeated = reduce(Column.__or__, [F.coalesce(d, F.lit(False)) for d in differs])
    message = _message(keys, ", ".join(columns))
    return one.select(
        *keys, *[_guarded(F.col(f"_low_{c}"), repeated, on_repeat, message).alias(c) for c in columns],
        *([repeated.alias(flag)] if flag else []),
    )


def keys_with_many_values(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys a scalar look-up would fail on, as they have several distinct values."""
    low, high = F.min(value).alias("low"), F.max(value).alias("high")
    return rows.groupBy(*keys).agg(low, high).filter(F.col("low") != F.col("high")).select(*keys)


def membership_flag(
    rows: DataFrame,
    members: DataFrame,
    key: str,
    flag: str,
    spread_by: Sequence[str],
    yes: str = "Yes",
    no: str = "No",
) -> DataFrame:
    """Whether the key occurs in ``members``, which may repeat and hold nulls.

    The rows of a key that very many share are split, see :func:`spread_left_join`.
    """
    known = members.filter(F.col(key).isNotNull()).select(key).distinct()
    marked = spread_left_join(rows, known.withColumn("_member", F.lit(True)), [key], spread_by)
    return marked.withColumn(flag, F.when(F.col("_member"), yes).otherwise(no)).drop("_member")


def values_by_name(
    pairs: DataFrame,
    key: Sequence[str],
    name: str,
    value: str,
    columns: Mapping[str, str],
    pick: str = "min",
) -> DataFrame:
    """Name/value rows to columns, for a fixed list of names, in one aggregate.

    ``columns`` maps a name to its output column; other names are dropped before
    the shuffle.
    """
    choose = {"min": F.min, "max": F.max}[pick]
    cells = [
        choose(F.when(F.col(name) == text, F.col(value))).alias(out)
        for text, out in columns.items()
    ]
    return pairs.filter(F.col(name).isin(list(columns))).groupBy(*key).agg(*cells)


def single_values_by_name(
    pairs: DataFrame,
    key: Sequence[str],
    name: str,
    value: str,
    columns: Mapping[str, str],
    on_repeat: str = "raise",
    flag: str | None = None,
) -> DataFrame:
    """:func:`values_by_name` for names that should have one value per key.

    Equal values count as one, nulls are no value. Where a name has several, the key fails the job
    or has a null in that column, as :func:`single_row` does; ``flag`` lists the columns.
    """
    cells = pairs.filter(F.col(name).isin(list(columns))).groupBy(*key).agg(*[
        f(F.when(F.col(name) == text, F.col(value))).alias(f"_{n}_{out}")
        for text, out in columns.items() for n, f in (("low", F.min), ("high", F.max))
    ])
    repeated = {out: F.coalesce(F.col(f"_low_{out}") != F.col(f"_high_{out}"), F.lit(False)) for out in columns.values()}
    found = [_guarded(F.col(f"_low_{out}"), r, on_repeat, _message(key, out)).alias(out) for out, r in repeated.items()]
    named = F.nullif(F.concat_ws(",", *[F.when(r, out) for out, r in repeated.items()]), F.lit(""))
    return cells.select(*key, *found, *([named.alias(flag)] if flag else []))


def nonzero_unit_cost(costs: DataFrame, cost_type: int = 2) -> DataFrame:
    """Unit cost by item and organization, to 5 places, for one cost type."""
    return costs.filter((F.col("itemCost") != 0) & (F.col("costTypeId") == cost_type)).select(
        "itemId", "organizationId", F.round("itemCost", 5).alias("unitCost")
    )


# Item attribute names and the columns they become.
ITEM_ATTRIBUTES = {
    "Product Code": "productCode",
    "Product Pack": "productPack",
    "Size": "skuSize",
    "Additional Description": "variant",
    "Sub Variant": "subVariant",
}
# Currencies that have a credit limit column.
CREDIT_LIMITS = {"KES": "kesCreditLimit", "USD": "usdCreditLimit", "GBP": "gbpCreditLimit"}


def item_attributes(pairs: DataFrame) -> DataFrame:
    return values_by_name(pairs, ["itemId"], "elementName", "elementValue", ITEM_ATTRIBUTES)


def credit_limits(amounts: DataFrame, key: Sequence[str]) -> DataFrame:
    """The largest limit per currency."""
    return values_by_name(amounts, key, "currencyCode", "creditLimit", CREDIT_LIMITS, pick="max")


def single_credit_limits(
    amounts: DataFrame, key: Sequence[str], on_repeat: str = "raise", flag: str | None = None
) -> DataFrame:
    """The one limit per currency; different ones for a key and currency are an error."""
    return single_values_by_name(
        amounts, key, "currencyCode", "creditLimit", CREDIT_LIMITS, on_repeat, flag
    )
