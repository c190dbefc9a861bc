"""Vectors that can be compared, and classes of equal ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import matrix, written


def comparable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part; components as doubles, without negative zero.

    Rows with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components, take no part. Vectors of another length than most rows'
    (ties: the longer) have no nearness to them and take no part either.
    """
    doubled = rows.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.transform(vector_column, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    valid = doubled.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0)
    )
    sizes = valid.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return valid.where(F.size("vector") == (sizes["size"] if sizes else 0))


def sample(rows: DataFrame, at_most: int) -> np.ndarray:
    """A matrix of about ``at_most`` vectors, chosen by a hash of the id; all of them if there are fewer."""
    count = rows.count()
    if not count:
        return np.zeros((0, 0))
    chosen = rows
    if count > at_most:
        chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(1e6 * at_most / count))
    found = chosen.select("vec_id", "vector").toArrow().sort_by("vec_id")  # bounded by at_most
    return matrix(found.column("vector"))


def classes(rows: DataFrame) -> DataFrame:
    """``(vec_id, copies, vector)``: each distinct vector with its smallest id and its number of rows."""
    return written(
        rows.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .select("vec_id", "copies", "vector"),
        "vectors",
    )
