"""Joins of many rows to one row per key, safe for a key that most rows share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key that holds more of all rows than this is split into pieces of about this size.
SHARE = 0.02
# Keys the sketch keeps count of; its error is far below the share.
TRACKED = 10_000


def heavy_keys(rows: DataFrame, keys: Sequence[str], share: float = SHARE) -> dict[int, int]:
    """Hash of each key that holds more than ``share`` of the rows, and in how many pieces to cut it.

    One pass over the key columns with a sketch of bounded size; at most ``1 / share`` keys
    come back. A key without a value counts like any other.
    """
    most = int(1 / share) + 1
    top, total = (
        rows.select(F.xxhash64(*keys).alias("h"))
        .agg(F.expr(f"approx_top_k(h, {most}, {TRACKED})"), F.count(F.lit(1)))
        .head()
    )
    return {item: int(count / (total * share)) + 1 for item, count in top or () if count > total * share}


def _pieces(keys: Sequence[str], heavy: Mapping[int, int]) -> Column:
    """How many pieces a key is cut into; one unless it is heavy."""
    counts = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    return F.coalesce(F.try_element_at(counts, F.xxhash64(*keys)), F.lit(1))


def spread_left_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    share: float = SHARE,
    heavy: Mapping[int, int] | None = None,
) -> DataFrame:
    """Left join to a table made by an aggregate on the same keys.

    A plain join reuses the partitioning of that aggregate, and adaptive execution
    splits a skewed partition only where both sides come straight from a shuffle. So
    the rows of a heavy key are dealt over pieces by a hash of ``spread_by``, and
    the one table row of that key is copied to each; no other row is. Without a heavy key it is the
    plain join. The piece depends on the row alone: a task that is run again sends every
    row to the same place. ``heavy`` hands in what :func:`heavy_keys` found, else it is asked here.
    """
    heavy = heavy_keys(rows, keys, share) if heavy is None else heavy
    if not heavy:
        return rows.join(table, list(keys), "left")
    pieces = _pieces(keys, heavy)
    piece = F.pmod(F.xxhash64(*spread_by), pieces.cast("bigint")).cast("int")
    copies = table.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return rows.withColumn("_piece", piece).join(copies, [*keys, "_piece"], "left").drop("_piece")
