"""SimHash near-duplicates: fingerprints of word shingles, linked by a trie self-join.

Documents with one fingerprint are one class, so copies are never paired. Two
fingerprints that differ in at most ``budget`` bits agree in full on one of
``budget + 1`` blocks of bits. Each block in turn is rotated to the front; the
fingerprints that share its value lie below one node of that rotation's binary
trie, and that node joined with itself is one unit of work. The traversal
descends node pairs together, adds up the differing bits and drops a pair of
nodes as soon as the sum passes the budget. A node with very many fingerprints
is dealt out as the pairs of its descendants some levels down (those within the
budget), so no task has to hold it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import lean, local_components, texts, written
from netdays.llm.components import components

BITS = 64
SEED = 42

# Fingerprints below one trie node before it is dealt out as pairs of descendants.
NODE_LIMIT = 50_000
# Node pairs that one step of the traversal holds at most.
FRONTIER = 500_000
# Shingles whose bits are counted at once.
SHINGLES = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """The 64 majority bits of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle + 1)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    first = starts[:count].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, SHINGLES):
        hashes = np.fromiter(
            (digest(view[a:b], SEED) for a, b in zip(first[at:at + SHINGLES], last[at:at + SHINGLES])),
            np.uint64,
        )
        octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, names: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(doc_id, simhash)``, one row per row of ``docs``; the 64 bits as a signed long.

    ``names`` are the columns that go before the fingerprint.

    A text that is null or has no word has fingerprint zero; one of fewer words
    than a shingle is one shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(marks.view(np.int64))], [*names, "simhash"]
            )

    kinds = dict(docs.dtypes)
    return docs.select(*names, "text").mapInArrow(lean(run), ", ".join(f"{n} {kinds[n]}" for n in names) + ", simhash bigint")


def _bit_count(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int64)


def _traverse(marks: np.ndarray, roots: np.ndarray, depth: int, budget: int) -> Iterator[tuple]:
    """Index pairs within the budget, from pairs of root nodes at one depth.

    ``marks`` are sorted below every root. A row of ``roots`` is a pair of nodes,
    each the range of marks below it, and the bits in which they differ so far:
    (from, to, from, to, differing).
    """
    pending = [(depth, roots)]
    while pending:
        depth, pairs = pending.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            pending += [(depth, pairs[:half]), (depth, pairs[half:])]
            continue
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        sizes = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        pairs = pairs[~(same & (sizes[0] == 1))]
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        if single.any():
            a, b = pairs[single, 0], pairs[single, 2]
            near = _bit_count(marks[a] ^ marks[b]) <= budget
            yield a[near], b[near]
            pairs = pairs[~single]
        if not len(pairs):
            continue
        # Below a node the marks are sorted, so those with a zero at this depth come first.
        zeros = np.concatenate(([0], np.cumsum((marks >> np.uint64(BITS - 1 - depth)) & np.uint64(1) == 0)))
        split = [
            pairs[:, k] + zeros[pairs[:, k + 1]] - zeros[pairs[:, k]] for k in (0, 2)
        ]
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        halves = [
            [(pairs[:, k], split[k // 2]), (split[k // 2], pairs[:, k + 1])] for k in (0, 2)
        ]
        below = []
        for one in (0, 1):
            for other in (0, 1):
                low, high = halves[0][one], halves[1][other]
                differing = pairs[:, 4] + (one != other)
                keep = (low[0] < low[1]) & (high[0] < high[1]) & (differing <= budget)
                if one > other:  # the same two nodes as (0, 1) where a node meets itself
                    keep &= ~same
                below.append(np.stack([*low, *high, differing], axis=1)[keep])
        below = np.concatenate(below)
        if not len(below):
            continue
        if depth + 1 == BITS:  # leaves hold one mark each, as marks differ
            yield below[:, 0], below[:, 2]
        else:
            pending.append((depth + 1, below))


def spanning(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Indices of links that connect the same nodes without a circle.

    Every component takes its first link that leaves it, until none does.
    """
    label, taken = np.arange(count), []
    links = np.arange(len(left))
    while True:
        one, other = label[left[links]], label[right[links]]
        leaving = one != other
        links, one, other = links[leaving], one[leaving], other[leaving]
        if not len(links):
            return np.concatenate(taken) if taken else links
        first = np.full(count, len(left))
        np.minimum.at(first, one, links)
        np.minimum.at(first, other, links)
        new = np.unique(first[first < len(left)])
        taken.append(new)
        label = local_components(count, label[left[new]], label[right[new]])[label]


def _node_links(units: dict[str, np.ndarray], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the marks in some whole units of work; each is a pair within the budget."""
    marks = units["mark"].view(np.uint64)
    unit = np.stack([units[k] for k in ("block", "node", "one", "other")], axis=1)
    starts = np.flatnonzero(np.any(unit[1:] != unit[:-1], axis=1)) + 1
    starts, ends = np.concatenate(([0], starts)), np.concatenate((starts, [len(marks)]))
    # Within a unit the marks of the one node come before those of the other.
    width = units["width"][starts].astype(np.uint64)
    one = (units["one"][starts] != units["other"][starts])
    middle = ends.copy()
    for k in np.flatnonzero(one):
        side = units["side"][starts[k]:ends[k]]
        middle[k] = starts[k] + np.searchsorted(side, 1)
    differing = _bit_count((units["one"][starts] ^ units["other"][starts]).astype(np.uint64))
    roots = np.stack([
        starts, np.where(one, middle, ends), np.where(one, middle, starts), ends, differing
    ], axis=1)
    roots = roots[(roots[:, 0] < roots[:, 1]) & (roots[:, 2] < roots[:, 3])]
    width = width[(starts < np.where(one, middle, ends)) & (np.where(one, middle, starts) < ends)]
    found: list[tuple] = []
    block = BITS // (budget + 1)
    for depth in np.unique(width):
        found += _traverse(marks, roots[width == depth], block + int(depth), budget)
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty
    left, right = (np.concatenate(x) for x in zip(*found))
    # A fingerprint may lie in several units; links stay inside one mark's unit rows.
    tree = spanning(len(marks), left, right)
    return left[tree], right[tree]


def trie_links(marks: DataFrame, budget: int = 3, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links ``(a, b)`` of ids that join all ids of marks within the budget.

    ``marks`` has distinct ``simhash`` values and an ``id`` each. Instead of all
    pairs of a dense group, links that connect the same marks come back; each of
    them is a pair within the budget that the traversal found.
    """
    blocks = budget + 1
    if BITS % blocks:
        raise ValueError("the number of blocks must divide 64")
    size = BITS // blocks
    rotated = (
        marks.select("id", "simhash", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        .withColumn(
            "mark",
            F.when(F.col("block") == 0, F.col("simhash")).otherwise(
                F.expr(f"shiftleft(simhash, block * {size}) | shiftrightunsigned(simhash, {BITS} - block * {size})")
            ),
        )
        .withColumn("node", F.shiftrightunsigned("mark", BITS - size))
        .select("id", "block", "node", "mark")
    )
    # How many levels further down a crowded node is cut; most are not.
    crowded = written(
        rotated.groupBy("block", "node").count().where(F.col("count") > node_limit)
        .select(
            "block", "node",
            F.least(F.lit(12), F.ceil(F.log2(F.col("count") / node_limit))).cast("int").alias("width"),
        ),
        "crowded",
    )
    within = rotated.join(crowded, ["block", "node"], "left").withColumn("width", F.coalesce("width", F.lit(0)))
    step = F.expr(f"shiftrightunsigned(shiftleft(mark, {size}), {BITS} - width)")
    units = (
        within.withColumn("own", F.when(F.col("width") == 0, F.lit(0).cast("bigint")).otherwise(step))
        .withColumn(
            "met",
            F.explode(
                F.when(F.col("width") == 0, F.array(F.lit(0).cast("bigint"))).otherwise(
                    F.filter(
                        F.sequence(F.lit(0).cast("bigint"), F.expr("shiftleft(1L, width) - 1")),
                        lambda other: F.bit_count(F.col("own").bitwiseXOR(other)) <= budget,
                    )
                )
            ),
        )
        .select(
            "block", "node", F.least("own", "met").alias("one"), F.greatest("own", "met").alias("other"),
            (F.col("own") > F.col("met")).cast("int").alias("side"), "width", "mark", "id",
        )
    )
    keys = ("block", "node", "one", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: pa.Table) -> pa.RecordBatch:
            columns = {k: held.column(k).to_numpy().astype(np.int64) for k in (*keys, "side", "width", "mark")}
            a, b = _node_links(columns, budget)
            ids = held.column("id").combine_chunks()
            return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < NODE_LIMIT:
                continue
            rows = pa.Table.from_batches(held)
            unit = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in keys], axis=1)
            last = np.flatnonzero(np.any(unit != unit[-1], axis=1))
            if not len(last):
                continue  # one unit so far: wait for its end
            whole = int(last[-1]) + 1
            yield links(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    return (
        units.repartition(*keys).sortWithinPartitions(*keys, "side", "mark")
        .mapInArrow(lean(run), "a bigint, b bigint")
    )


def simhash_components(docs: DataFrame, shingle: int = 3, budget: int = 3,
                       node_limit: int = NODE_LIMIT) -> DataFrame:
    """``(doc_id, simhash, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``budget``
    differing bits, the row's own included. A row with a null id links nothing and
    has a null component. Rows may repeat; other columns are not read, so their
    names cannot clash. An empty table gives an empty table.
    """
    marked = written(
        fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), shingle), "simhash"
    )
    classes = written(
        marked.where("doc_id is not null").groupBy("simhash").agg(F.min("doc_id").alias("id")), "classes"
    )
    reached = components(trie_links(classes, budget, node_limit))
    resolved = written(
        classes.join(reached, classes["id"] == reached["node"], "left")
        .select("simhash", F.coalesce("component", "id").alias("component_id")),
        "resolved",
    )
    known = marked.where("doc_id is not null").join(resolved, "simhash")
    unknown = marked.where("doc_id is null").withColumn("component_id", F.lit(None).cast("bigint"))
    columns = ["doc_id", "simhash", "component_id"]
    return known.select(*columns).unionByName(unknown.select(*columns))


def one_of_each(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest id stays.

    Components are those of the fingerprints, so an id that repeats with different texts
    links nothing; of one id's texts in a component that of the smallest hash stays. Rows
    that repeat id and text are one; rows with a null id link nothing and stay.
    """
    id_ = F.col("doc_id").cast("bigint").alias("__id")
    numbered = docs.where("doc_id is not null").withColumn("__text", F.xxhash64("text"))
    marked = written(fingerprints(numbered.select(id_, "text", "__text"), shingle, ("__id", "__text")), "simhash")
    classes = written(marked.groupBy("simhash").agg(F.min(F.struct("__id", "__text")).alias("first")), "classes")
    reached = components(trie_links(classes.select("simhash", F.col("simhash").alias("id")), budget))
    kept = written(
        classes.join(reached, classes["simhash"] == reached["node"], "left")
        .groupBy(F.coalesce("component", "simhash")).agg(F.min("first").alias("first"))
        .select(F.col("first.__id").alias("__kept"), F.col("first.__text").alias("__kept_text")),
        "kept",
    )
    same = (F.col("doc_id").cast("bigint") == F.col("__kept")) & (F.col("__text") == F.col("__kept_text"))
    first = numbered.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__text"])
    return first.drop("__text").unionByName(docs.where("doc_id is null"))
