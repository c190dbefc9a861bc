"""Data quality: profiles, rejects, orphans and counts, one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, all columns in one aggregate."""
    return rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in (columns or rows.columns)]
    )


def too_long(rows: DataFrame, limits: Mapping[str, int], key: str) -> DataFrame:
    """Key, column and length of each text longer than its limit."""
    checks = [
        F.struct(F.lit(c).alias("field"), F.length(c).alias("length"), F.lit(n).alias("allowed"))
        for c, n in limits.items()
    ]
    return (
        rows.select(key, F.inline(F.array(*checks)))
        .filter(F.col("length") > F.col("allowed"))
    )


def with_reject_reason(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rejectReason``: names of the broken rules, null where all hold.

    A rule is the condition a good row meets; an unknown outcome breaks it.
    """
    broken = [F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]
    return rows.withColumn("rejectReason", F.nullif(F.concat_ws(",", *broken), F.lit("")))


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} missing": F.col(c).isNotNull() for c in columns}


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    """Texts may be null, but no longer than their limit."""
    return {f"{c} too long": F.col(c).isNull() | (F.length(c) <= n) for c, n in limits.items()}


def accepted(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("rejectReason").isNull()).drop("rejectReason")


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("rejectReason").isNotNull())


def orphans(rows: DataFrame, parents: DataFrame, foreign: str, primary: str) -> DataFrame:
    """Rows whose foreign key is set and has no parent."""
    keys = parents.select(F.col(primary).alias(foreign))
    return rows.filter(F.col(foreign).isNotNull()).join(keys, foreign, "left_anti")


def stage_counts(rows: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows that reach each stage, as one aggregate over stage conditions."""
    return rows.agg(*[F.count_if(reached).alias(name) for name, reached in stages.items()])
