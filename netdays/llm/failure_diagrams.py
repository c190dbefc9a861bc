"""How filters overlap, whatever their order: decision diagrams of failure masks.

A document's mask says which filters it fails. Counting masks per part is all that needs
the documents; map tasks combine the counts, so a part may hold any share of the rows. A
part's masks, at most 2 to the number of filters, become a decision diagram: a level per
filter, a low and a high child for pass and fail, equal rests of the table shared, and in
each node the weight of all documents below it.

Filters applied from left to right are the levels from the root: who passes all so far is
on the path of low children, the weight of a high child beside it is what that
step removes. Exchanging two adjacent filters rewrites only the nodes of their two levels,
and plain changes reach every order by one such exchange each.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import written

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
EMPTY = 0  # the node of a rest without documents


def plain_changes(count: int) -> Iterator[int]:
    """Places to exchange with their right neighbour, so that every order of ``count`` comes up once."""
    if count < 2:
        return
    inner = plain_changes(count - 1)
    while True:
        for down in range(count - 2, -1, -1):
            yield down
        step = next(inner, None)
        if step is None:
            return
        yield step + 1
        yield from range(count - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step


class Diagram:
    """A reduced ordered diagram over weighted masks; bit ``i`` of a mask is variable ``i``.

    ``order[k]`` is the variable of level ``k``. A node is a number; ``below`` gives its low
    and high child, ``weight`` the sums of all masks below it.
    """

    def __init__(self, variables: int, masks: Mapping[int, tuple[int, ...]]):
        self.order = list(range(variables))
        self.zero = (0,) * len(next(iter(masks.values()), ()))
        self.weight: dict[int, tuple[int, ...]] = {EMPTY: self.zero}
        self.below: dict[int, tuple[int, int]] = {EMPTY: (EMPTY, EMPTY)}
        self.leaves: dict[tuple[int, ...], int] = {self.zero: EMPTY}
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(variables)]
        self.last = EMPTY
        self.root = self._built(0, dict(masks))

    def _new(self, weight: tuple[int, ...], children: tuple[int, int]) -> int:
        self.last += 1
        self.weight[self.last], self.below[self.last] = weight, children
        return self.last

    def _leaf(self, weight: tuple[int, ...]) -> int:
        if weight not in self.leaves:
            self.leaves[weight] = self._new(weight, (EMPTY, EMPTY))
        return self.leaves[weight]

    def _node(self, level: int, low: int, high: int) -> int:
        """The one node of a level with these children."""
        if low == high == EMPTY:
            return EMPTY
        known = self.levels[level]
        if (low, high) not in known:
            known[low, high] = self._new(tuple(map(sum, zip(self.weight[low], self.weight[high]))), (low, high))
        return known[low, high]

    def _built(self, level: int, masks: dict[int, tuple[int, ...]]) -> int:
        if not masks:
            return EMPTY
        if level == len(self.order):
            return self._leaf(masks[next(iter(masks))])
        bit = 1 << self.order[level]
        low = self._built(level + 1, {m: w for m, w in masks.items() if not m & bit})
        high = self._built(level + 1, {m: w for m, w in masks.items() if m & bit})
        return self._node(level, low, high)

    def exchange(self, level: int) -> None:
        """Exchange the variables of a level and the next; nodes of all other levels stay as they are."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        upper, lower = self.levels[level], self.levels[level + 1]
        self.levels[level], self.levels[level + 1] = {}, {}
        for (low, high), node in upper.items():
            (pass_pass, pass_fail), (fail_pass, fail_fail) = self.below[low], self.below[high]
            children = (self._node(level + 1, pass_pass, fail_pass), self._node(level + 1, pass_fail, fail_fail))
            self.below[node] = children
            self.levels[level][children] = node
        for gone in set(lower.values()) - set(self.levels[level + 1].values()):
            del self.below[gone], self.weight[gone]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """``(variable, kept, removed)`` of each step in the present order."""
        found, node = [], self.root
        for variable in self.order:
            node, failing = self.below[node]
            found.append((variable, self.weight[node], self.weight[failing]))
        return found

    def orders(self) -> Iterator[tuple[tuple[int, ...], list]]:
        """Every order of the variables with its steps."""
        yield tuple(self.order), self.steps()
        for level in plain_changes(len(self.order)):
            self.exchange(level)
            yield tuple(self.order), self.steps()


def part_report(masks: Mapping[int, tuple[int, ...]], names: list[str]) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique fails, shapley, further weights lost)`` of one part.

    The first weight counts documents.
    """
    diagram = Diagram(len(names), masks)
    failing, alone, shapley, found = {}, {}, dict.fromkeys(range(len(names)), 0), []
    for order, steps in diagram.orders():
        # Where a filter comes first it removes all that fail it, where last those that only it finds.
        failing[order[0]], alone[order[-1]] = steps[0][2][0], steps[-1][2][0]
        text = "".join(names[v] for v in order)
        for at, (variable, kept, removed) in enumerate(steps, 1):
            shapley[variable] += removed[0]
            found.append((text, at, variable, kept[0], removed))
    return [
        (text, at, kept, removed[0], failing[v] - removed[0], alone[v], shapley[v], *removed[1:])
        for text, at, v, kept, removed in found
    ]


def audit(masks: DataFrame, names: list[str], weights: list[str]) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, ..._lost, shapley)``.

    ``masks`` has one row per part and mask with the sums of each weight, the first of which
    counts documents; ``names`` are the filters of the bits from the lowest. One row comes
    back per part, order of the filters and step. All orders are walked, so filters should be
    few: five have 120 orders, eight 40,320. A part may be null; an empty table gives an empty one.
    """
    counts = ["kept", "removed", "redundant", "unique_fails", "shapley", *[f"{w}_lost" for w in weights[1:]]]
    schema = f"part string, filter_order string, step int, {', '.join(f'{c} bigint' for c in counts)}"
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(counts)]

    def one_part(rows: pa.Table) -> pa.Table:
        numbers = zip(rows.column("mask").to_pylist(), *(rows.column(w).to_pylist() for w in weights))
        part = rows.column("part")[0].as_py()
        report = [(part, *line) for line in part_report({m: tuple(w) for m, *w in numbers}, names)]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*report), kinds)]
        return pa.Table.from_arrays(columns, ["part", "filter_order", "step", *counts])

    return masks.groupBy("part").applyInArrow(one_part, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """Too short, too repetitive, too many capitals, odd signs; ``text`` must not be null."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 80 * F.size(words).cast("bigint"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint") > 10 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


FILTERS = ["A", "B", "C", "D", "E"]
WEIGHTS = ["documents", "good", "toxic"]


def corpus_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, documents, good, toxic)`` of a corpus by language.

    Filters A to D are :func:`text_failures`; E fails a document whose text a smaller id
    has anywhere in the table, by SHA-256. Null texts are empty and null languages the empty
    string. A document is good or toxic if any label row of its id says so. Rows that repeat
    an id with the same text do not fail E for each other; a null id is neither smaller nor
    larger than another, and has no labels.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = sum((failed.cast("int") * (1 << i) for i, failed in enumerate(text_failures(text).values())), F.lit(0))
    cells = (
        docs.select(
            "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        )
        .groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("documents"))
    )
    marks = written(
        labels.where("doc_id is not null").groupBy("doc_id").agg(
            F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
            F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
        ),
        "marks",
    )
    marked = written(cells.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"]), "cells")
    shared = written(
        marked.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("digest", "first"),
        "shared",
    )
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return (
        marked.join(shared, "digest", "left")
        .groupBy("part", (F.col("mask") + repeated * (1 << 4)).alias("mask"))
        .agg(
            F.sum("documents").alias("documents"),
            F.sum(F.col("documents") * F.col("good")).alias("good"),
            F.sum(F.col("documents") * F.col("toxic")).alias("toxic"),
        )
    )


def corpus_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit` of :func:`corpus_masks`."""
    return audit(corpus_masks(docs, labels), FILTERS, WEIGHTS)
