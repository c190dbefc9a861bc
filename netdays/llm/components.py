"""Connected components of a link table, by alternating star contractions.

Every round keeps the links as a written table in the shared folder, so a lost
executor costs one round at most, and nothing but a count and a checksum
reaches the driver. Minima are aggregated before the join that hands them out,
and both sides of that join are read anew, so a hub's links can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import written


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = written(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("least")),
        "star",
    )
    return (
        both.where("other > node").join(least, "node")
        .select(F.col("other").alias("high"), F.col("least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = written(links.groupBy("high").agg(F.min("low").alias("least")), "star")
    moved = (
        links.join(least, "high").where("low > least")
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
    )
    return moved.unionByName(least.select("high", F.col("least").alias("low"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node that has a link, from links ``(a, b)``.

    The component is the smallest node that can be reached. Links may repeat,
    come in either direction or join a node with itself; nulls link nothing. An
    empty table gives an empty table.
    """
    links = written(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "links",
    )
    before = _state(links)
    while before[0]:
        links = written(_small_star(written(_large_star(links), "links")), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
