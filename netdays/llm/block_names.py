"""Exact duplicates by block naming: equal texts, and only those, get one integer name.

1. A text is cut into blocks of ``size`` characters. The distinct blocks are sorted
   and numbered: a block's name is its place in that order.
2. Adjacent names are paired; the distinct pairs are sorted and numbered in turn. This
   repeats until every text has one name, which takes log2 of the blocks of the
   longest text. A text with fewer blocks is ready earlier, so its identity is its
   level and its name there.

No two texts share an identity: names come from comparing blocks and pairs
themselves. Block texts move once, for that comparison. To bring a name back
to its places, a label of 128 bits stands for the block; the named blocks show
whether two of them share a label, and if so other labels are drawn.

Copies are combined in the map tasks before blocks or pairs are sorted; the places of
a block that a third of all rows share are read from a written table, so that
adaptive execution can split them in the join.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import written

BLOCK = 4096
ABSENT = -1  # stands for the second of a pair that has only a first


def without_blanks(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def blocks(text: Column, size: int) -> Column:
    """The text's blocks of ``size`` characters, the last may be shorter; an empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}+"), F.lit(0))
    return F.when(F.size(cut) == 0, F.array(F.lit(""))).otherwise(cut)


def label(block: Column, draw: int) -> tuple[Column, Column]:
    """128 bits of a block, other ones for each draw."""
    return F.xxhash64(F.lit(2 * draw), block), F.xxhash64(F.lit(2 * draw + 1), block)


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Distinct rows sorted and numbered; written, as numbers must not change when read again."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(docs: DataFrame, text: Column, size: int, labels: Callable, draw: int) -> DataFrame:
    """``(a, b, name)`` of every distinct block, ``(a, b)`` being its label."""
    found = docs.select(F.explode(blocks(text, size)).alias("block"))
    a, b = labels(F.col("block"), draw)
    distinct = found.select(a.alias("a"), b.alias("b"), "block").distinct()
    return written(_numbered(distinct, "block").select("a", "b", "name"), "block-names")


def identities(
    docs: DataFrame, text: Column, carry: Sequence[Column], size: int = BLOCK, labels: Callable = label
) -> DataFrame:
    """``(row, level, name)`` and the ``carry`` columns, one row per row of ``docs``.

    Two rows have the same level and name if and only if their texts are equal. ``docs``
    is read twice for one draw of labels.
    """
    for draw in itertools.count():
        names = _named_blocks(docs, text, size, labels, draw)
        if names.groupBy("a", "b").count().where("count > 1").isEmpty():
            break
    places = F.transform(blocks(text, size), lambda block: F.struct(*[
        x.alias(k) for k, x in zip("ab", labels(block, draw))
    ]))
    rows = written(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*carry).alias("carry"), places.alias("places")),
        "rows",
    )
    named = written(
        rows.select("row", F.size("places").alias("n"), F.posexplode("places").alias("at", "label"))
        .select("row", "n", "at", "label.a", "label.b").join(names, ["a", "b"]).select("row", "n", "at", "name"),
        "named",
    )
    done = []
    for level in itertools.count():
        done.append(named.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        rest = named.where("n > 1")
        if rest.isEmpty():
            break
        second = F.col("at") % 2 == 1
        pairs = written(
            rest.groupBy("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.shiftright("at", 1).alias("at"))
            .agg(
                F.max(F.when(~second, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(second, F.col("name"))), F.lit(ABSENT)).alias("b"),
            ),
            "pairs",
        )
        names = written(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "pair-names")
        named = written(pairs.join(names, ["a", "b"]).select("row", "n", "at", "name"), "named")
    found = done[0]
    for other in done[1:]:
        found = found.unionByName(other)
    return found.join(rows.select("row", "carry.*"), "row")


def exact_groups(docs: DataFrame, text: Column | None = None, size: int = BLOCK, carry: Sequence[str] = (),
                 labels: Callable = label) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Rows are of one group if their texts are equal without ASCII white space, or in what
    ``text`` makes of them. The row with the most characters stays, of equally long ones
    that with the smallest ``doc_id``, of these any one; a null id comes after all others
    and its ``keep_id`` is null if such a row stays. Null texts count as empty, and empty
    texts are equal. Rows may repeat; a text may be of any length. ``carry`` names further
    columns to return in a struct ``carried``; no others are read. An empty table gives an empty one.
    """
    text = without_blanks(F.col("text")) if text is None else text
    extra = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    named = written(
        identities(
            docs, text,
            [F.col("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("points"), F.sha2(text, 256).alias("text_sha256"), *extra],
            size, labels,
        ),
        "identities",
    )
    place = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("first"))
    groups = written(
        named.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(place).alias("stays"))
        .select("level", "name", "group_size", F.col("stays.id").alias("keep_id"), F.col("stays.first").alias("first")),
        "groups",
    )
    return named.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"), "text_sha256",
        *(["carried"] if carry else []),
    )


def without_copies(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``docs`` with the one row of each group that stays, all its columns unchanged."""
    return exact_groups(docs, text, carry=docs.columns).where("kept").select("carried.*")
