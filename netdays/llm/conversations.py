"""Conversations repaired by the cheapest edits, ties by the least audit.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: an optional system
turn, then user and assistant in turn. Row by row an edit is Keep (0), Rerole (1) or Delete
(2), and an empty turn may be Inserted (5) anywhere. Blank and repeated rows must be deleted,
and a truncated row that stays adds 5. The initials of the edits are the audit; of the cheapest
ones the ASCII-least is taken.

1. Rows are sorted by conversation and turn over all tasks (a range of the order each), given
   dense places and cut into chunks of ``chunk`` places, so a conversation may have any length.
2. *Costs.* A node is a place and a state of the pattern. The part of a conversation in a
   chunk gives the least cost from each state at its start to each at its end; such matrices
   combine by min-plus products, doubling the chunks they span, to the cost that is left
   after each chunk.
3. *Prefix-doubling path ranking.* Within a chunk, nodes have their optimal arcs. Ranks by the first
   edit are refined by pairs (own rank, rank of the node that many edits on) to audits of 2, 4, 8...
   edits, while the pointers double. A node's edits all have different initials, so the least first
   edit gives the node that the least audit goes through. The doubled pointers give the nodes of
   the least path from each of the four states, and where it leaves the chunk.
4. Those four exits compose like the matrices, from the front, to the state each chunk begins
   with, which picks one of the four edits of each row.

Only chunks are held in memory. Digests of whole conversations are taken while rows stream by
in order, as a running hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netdays.llm.common import unit_starts, whole_units, written

CHUNK = 4096
BATCH = 1 << 14
BLANKS = " \t\n\x0b\x0c\r"
ROW_BITS = 33

# States of the pattern: nothing yet, after system, after user, after assistant.
STATES = 4
NEXT = np.array([2, 2, 3, 2])  # by a user or assistant turn, whichever fits
ROLE = ("user", "user", "assistant", "user")  # that turn's role
INITIALS = "sua"
KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])  # by initial and state
TRAILING = (0, 2, 1, 0)  # turns to insert at the end
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
FAR = 1 << 40
BLANK, REPEATED, TRUNCATED = 1, 2, 3
ACTIONS = "DKR"


def placed(rows: DataFrame) -> DataFrame:
    """``(conv, place, turn, role, text)`` in a written table: dense places in order.

    ``conv`` spells the id, null as the empty string. Equal turns are in the order of role, 64-bit
    hash of the text and text; null turns come first.
    """
    keyed = rows.select(
        F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"),
        "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "hash"]
    raw = written(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order, "text")
        .select(F.monotonically_increasing_id().alias("raw"), "conv", "turn", "role", "text"),
        "turns",
    )
    part = F.shiftright("raw", ROW_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort.
    starts = raw.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return raw.withColumn("part", part).join(F.broadcast(starts), "part").select(
        "conv", (F.col("start") + F.col("raw").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("place"), "turn", "role", "text"
    )


def last_sign(text: Column) -> Column:
    return F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)


def faulty(turns: DataFrame, chunk: int) -> DataFrame:
    """``(conv, chunk, place, turn, initial, fault)``: each row's first fault, 0 for none; written.

    Role and text were seen earlier if an earlier row has the same SHA-256.
    """
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS))
    marked = turns.select(
        "conv", "place", "turn",
        F.when((F.col("role") != "") & (initial > 0), initial - 1).otherwise(len(INITIALS)).alias("initial"),
        (F.rtrim("text", F.lit(BLANKS)) == "").alias("blank"),
        last_sign(F.col("text")).isin(".", "!", "?").alias("whole"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )
    seen = written(
        marked.where("not blank").groupBy("conv", "digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first < last").select("conv", "digest", "first"),
        "seen",
    )
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("first"), REPEATED)
        .when(~F.col("whole"), TRUNCATED).otherwise(0)
    )
    return written(
        marked.join(seen, ["conv", "digest"], "left")
        .select("conv", F.floor(F.col("place") / chunk).alias("chunk"), "place", "turn", "initial", fault.alias("fault")),
        "faults",
    )


class Units:
    """Runs of rows of one conversation in one chunk, longest first, to be stepped through together."""

    def __init__(self, rows: pa.Table):
        self.starts = unit_starts(rows, ("chunk", "conv"))
        self.lengths = np.diff(np.append(self.starts, rows.num_rows))
        self.by_length = np.argsort(-self.lengths, kind="stable")
        self.initial = rows.column("initial").to_numpy().astype(np.int64)
        fault = rows.column("fault").to_numpy()
        self.gone = (fault == BLANK) | (fault == REPEATED)
        self.extra = np.where(fault == TRUNCATED, UNFINISHED, 0)

    def backward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(units, rows)`` of each step, from the last row of the longest unit on."""
        sizes = self.lengths[self.by_length]
        for step in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
            units = self.by_length[:int(np.searchsorted(-sizes, -step, side="left"))]
            yield units, self.starts[units] + step

    def costs(self, rows: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs by state of Delete, Keep and Rerole of the rows; ``after[unit, state, ...]`` is what follows."""
        wide = (slice(None),) + (None,) * (after.ndim - 2)
        target = KEEP[self.initial[rows]]
        extra, gone = self.extra[rows][wide], self.gone[rows][wide]
        delete, keep, rerole = after + DELETE, np.full_like(after, FAR), np.full_like(after, FAR)
        for state in range(STATES):
            kept = after[np.arange(len(rows)), np.maximum(target[:, state], 0)] + extra
            keep[:, state] = np.where(gone | (target[:, state] < 0)[wide], FAR, kept)
            rerole[:, state] = np.where(gone, FAR, after[:, NEXT[state]] + REROLE + extra)
        return delete, keep, rerole

    def before(self, rows: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Least costs from the rows on, inserted turns included."""
        least = np.minimum.reduce(self.costs(rows, after))
        for _ in range(2):
            least = np.minimum(least, least[:, NEXT] + INSERT)
        return np.minimum(least, FAR)


def unit_matrices(rows: pa.Table) -> pa.RecordBatch:
    """Of each unit: least costs from state to state, illegal neighbours, first and last initial."""
    units = Units(rows)
    count = len(units.starts)
    least = np.tile(np.where(np.eye(STATES, dtype=bool), 0, FAR), (count, 1, 1))
    for some, at in units.backward():
        least[some] = units.before(at, least[some])
    ends = units.starts + units.lengths - 1
    one, two = units.initial[:-1], units.initial[1:]
    fits = ((one == 0) & (two == 1)) | ((one == 1) & (two == 2)) | ((one == 2) & (two == 1))
    inner = np.append(~fits, False)
    inner[ends] = False
    illegal = np.add.reduceat(inner.astype(np.int64), units.starts) if count else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("conv").combine_chunks().take(pa.array(units.starts)), rows.column("chunk").combine_chunks().take(pa.array(units.starts)),
            pa.array(illegal), pa.array(units.initial[units.starts]), pa.array(units.initial[ends]),
            pa.array(list(least.reshape(count, -1)), pa.list_(pa.int64())),
        ],
        ["conv", "chunk", "illegal", "first", "last", "matrix"],
    )


def least_paths(first: np.ndarray, target: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least label paths from ``entries`` and where they end, by prefix doubling.

    ``first[node]`` is the least label (from 1) of a node's arcs, 0 at a last node, and ``target`` the
    node that arc leads to, itself at a last node. Returns which entry and which node each
    step of a path has, in order, and the last nodes of the entries.
    """
    rank, hop, steps = first, target, (first > 0).astype(np.int64)
    hops = [hop]
    while np.any(first[hop] > 0):
        # The rank of twice as many labels is that of the pair of halves.
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[hop], return_inverse=True)[1]
        steps = steps + steps[hop]
        hop = hop[hop]
        hops.append(hop)
    lengths = steps[entries]
    entry = np.repeat(np.arange(len(entries)), lengths)
    at = np.arange(len(entry)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    node = entries[entry]
    for k, doubled in enumerate(hops):
        node = np.where(at >> k & 1, doubled[node], node)
    return entry, node, hop[entries]


def unit_edits(rows: pa.Table) -> pa.RecordBatch:
    """Each row's edits for the four states a unit may begin with, and on a unit's first row the four exits.

    An edit is a number: state before it, turns inserted before it, place in ``ACTIONS``.
    """
    units = Units(rows)
    count, total = len(units.starts), rows.num_rows
    # A unit has one place more than rows: where it ends.
    unit = np.repeat(np.arange(count), units.lengths)
    place = np.arange(total) + unit
    ends = units.starts + units.lengths + np.arange(count)
    least = np.zeros((total + count, STATES), np.int64)
    least[ends] = np.array(rows.column("left").combine_chunks().take(pa.array(units.starts)).to_pylist(), np.int64).reshape(count, STATES)
    for some, at in units.backward():
        least[place[at]] = units.before(at, least[place[at] + 1])
    here, after = least[place], least[place + 1]
    delete, keep, rerole = units.costs(np.arange(total), after)
    insert = here[:, NEXT] + INSERT
    label = np.zeros((total + count, STATES), np.int64)
    target = np.arange((total + count) * STATES).reshape(-1, STATES)
    states = np.arange(STATES)
    follow = (place[:, None] + 1) * STATES
    kept_to = np.maximum(KEEP[units.initial], 0)
    # In the order of the initials D, I, K, R: the first that is optimal counts.
    options = (
        (delete, follow + states), (insert, place[:, None] * STATES + NEXT),
        (keep, follow + kept_to), (rerole, follow + NEXT),
    )
    for number, (cost, to) in reversed(list(enumerate(options, 1))):
        best = cost == here
        label[place] = np.where(best, number, label[place])
        target[place] = np.where(best, to, target[place])
    entries = ((units.starts + np.arange(count))[:, None] * STATES + states).reshape(-1)
    entry, node, last = least_paths(label.reshape(-1), target.reshape(-1), entries)
    # Which row each step of a path is at.
    row_of = np.zeros(total + count, np.int64)
    row_of[place] = np.arange(total)
    row, begun = row_of[node // STATES], entry % STATES
    step = label.reshape(-1)[node]
    inserts, action, state = np.zeros((3, total, STATES), np.int64)
    np.add.at(inserts, (row[step == 2], begun[step == 2]), 1)
    taken = step != 2
    action[row[taken], begun[taken]] = np.array([0, 0, 0, 1, 2])[step[taken]]
    # The state before the inserted turns is that of the first step at the row.
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (entry[1:] != entry[:-1])
    state[row[first], begun[first]] = node[first] % STATES
    edits = (state * 3 + inserts) * 3 + action
    exits: list = [None] * total
    for k, start in enumerate(units.starts):
        exits[start] = (last[k * STATES:(k + 1) * STATES] % STATES).tolist()
    return pa.RecordBatch.from_arrays(
        [
            rows.column("conv").combine_chunks(), rows.column("chunk").combine_chunks(), rows.column("place").combine_chunks(),
            rows.column("fault").combine_chunks(), pa.array(list(edits), pa.list_(pa.int64())), pa.array(exits, pa.list_(pa.int64())),
        ],
        ["conv", "chunk", "place", "fault", "edits", "exits"],
    )


def _by_chunk(rows: DataFrame, function, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_units(batches, ("chunk",), BATCH):
            yield function(held)

    return rows.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(run, schema)


def _doubled(units: DataFrame, column: str, combine, ahead: bool, longest: int) -> DataFrame:
    """Each unit's value combined with all that follow (or precede) it in its conversation."""
    step = 1
    while step < longest:
        moved = F.col("chunk") - step if ahead else F.col("chunk") + step
        other = units.select("conv", moved.alias("chunk"), F.col(column).alias("other"))
        both = units.join(other, ["conv", "chunk"], "left")
        units = written(
            both.select("conv", "chunk", F.when(F.col("other").isNull(), F.col(column)).otherwise(combine(F.col(column), F.col("other"))).alias(column)),
            "doubled",
        )
        step *= 2
    return units


def _product(one: Column, two: Column) -> Column:
    """Min-plus product of two matrices, given row by row."""
    cell = lambda k: F.array_min(F.transform(
        F.sequence(F.lit(0), F.lit(STATES - 1)),
        lambda m: F.get(one, (F.floor(k / STATES) * STATES + m).cast("int")) + F.get(two, (m * STATES + k % STATES).cast("int")),
    ))
    return F.transform(F.sequence(F.lit(0), F.lit(STATES * STATES - 1)), lambda k: F.least(cell(k), F.lit(FAR)))


def _left(matrix: Column) -> Column:
    """Cost from each state to the end of the conversation, the last turns inserted."""
    ends = F.array(*[F.lit(n * INSERT).cast("bigint") for n in TRAILING])
    return F.transform(
        F.sequence(F.lit(0), F.lit(STATES - 1)),
        lambda q: F.array_min(F.transform(
            F.sequence(F.lit(0), F.lit(STATES - 1)), lambda r: F.get(matrix, (q * STATES + r).cast("int")) + F.get(ends, r.cast("int"))
        )),
    )


@dataclass(frozen=True)
class Repair:
    """``turns`` (conv, place, turn, role, text), ``faults`` of the same rows, ``units`` with their
    ``illegal`` neighbours, and ``edits`` (conv, place, fault, state, inserts, action)."""

    turns: DataFrame
    faults: DataFrame
    units: DataFrame
    edits: DataFrame


def repair(rows: DataFrame, chunk: int = CHUNK) -> Repair:
    """The cheapest, ASCII-least edits of all conversations in ``rows`` (conv_id, turn, role, text).

    Null roles and texts are one space, null ids one conversation. Rows may repeat: the later ones
    are faults. Other columns are not read. An empty table gives empty tables.
    """
    turns = placed(rows)
    faults = faulty(turns, chunk)
    units = written(
        _by_chunk(faults, unit_matrices, "conv string, chunk bigint, illegal bigint, first bigint, last bigint, matrix array<bigint>"), "units"
    )
    # Conversations in several chunks; a chunk ends in at most one of them.
    spans = written(units.groupBy("conv").agg(F.min("chunk").alias("from"), F.max("chunk").alias("to")).where("from < to"), "spans")
    longest = spans.agg(F.coalesce(F.max(F.col("to") - F.col("from")) + 1, F.lit(0))).first()[0]
    spanning = units.join(spans, "conv", "left_semi")
    onward = _doubled(spanning.select("conv", "chunk", "matrix"), "matrix", _product, True, longest)
    left = onward.join(spans, "conv").where("chunk > from").select("conv", (F.col("chunk") - 1).alias("chunk"), _left(F.col("matrix")).alias("left"))
    ends = F.array(*[F.lit(n * INSERT).cast("bigint") for n in TRAILING])
    bounded = faults.join(left, ["conv", "chunk"], "left").withColumn("left", F.coalesce("left", ends)).drop("turn")
    four = written(
        _by_chunk(bounded, unit_edits, "conv string, chunk bigint, place bigint, fault int, edits array<bigint>, exits array<bigint>"), "edits"
    )
    passed = _doubled(
        four.where("exits is not null").join(spans, "conv", "left_semi").select("conv", "chunk", "exits"), "exits",
        lambda own, earlier: F.transform(earlier, lambda s: F.get(own, s.cast("int"))), False, longest,
    )
    entered = passed.select("conv", (F.col("chunk") + 1).alias("chunk"), F.get("exits", F.lit(0)).alias("entered"))
    code = F.get("edits", F.coalesce("entered", F.lit(0)).cast("int"))
    edits = four.join(entered, ["conv", "chunk"], "left").select(
        "conv", "place", "fault", F.floor(code / 9).cast("int").alias("state"),
        (F.floor(code / 3) % 3).cast("int").alias("inserts"), F.substring(F.lit(ACTIONS), (code % 3 + 1).cast("int"), F.lit(1)).alias("action"),
    )
    return Repair(turns, faults, units, edits)


def digests(found: Repair) -> DataFrame:
    """``(conv, cost, audit, repaired_sha256)`` of each conversation that has rows.

    The hash is over the repaired ``role:text``, joined by line feeds. Rows stream by in order,
    each behind its edit; a conversation's hash is sequential, so one task reads it.
    """
    none = F.lit(None)
    events = found.edits.select(
        "conv", "place", F.lit(0).alias("kind"), "fault", "inserts", "action", none.cast("string").alias("role"), none.cast("string").alias("text")
    ).unionByName(found.turns.select(
        "conv", "place", F.lit(1).alias("kind"), none.cast("int").alias("fault"), none.cast("int").alias("inserts"),
        none.cast("string").alias("action"), "role", "text",
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "cost", "audit", "repaired_sha256"]
        conv, state, cost, audit, digest, lines, edit = None, 0, 0, [], None, 0, None

        def line(role: str, text: str) -> None:
            nonlocal lines
            digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            lines += 1

        def insert(count: int) -> None:
            nonlocal state, cost
            for _ in range(count):
                line(ROLE[state], "")
                state, cost = int(NEXT[state]), cost + INSERT
                audit.append("I")

        def ended() -> tuple:
            insert(TRAILING[state])
            return conv, cost, "".join(audit), digest.hexdigest()

        def emitted(done: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[k]) for k in range(4)], names)

        for batch in batches:
            done = []
            for key, kind, fault, inserts, action, role, text in zip(
                *(batch.column(c).to_pylist() for c in ("conv", "kind", "fault", "inserts", "action", "role", "text"))
            ):
                if key != conv:
                    if conv is not None:
                        done.append(ended())
                    conv, state, cost, audit, digest, lines = key, 0, 0, [], hashlib.sha256(), 0
                if kind == 0:
                    edit = fault, inserts, action
                    continue
                fault, inserts, action = edit
                insert(inserts)
                audit.append(action)
                if action == "D":
                    cost += DELETE
                    continue
                if action == "R":
                    role, to = ROLE[state], int(NEXT[state])
                    cost += REROLE
                else:
                    to = int(KEEP[INITIALS.index(role[0]), state])
                line(role, text)
                state, cost = to, cost + (UNFINISHED if fault == TRUNCATED else 0)
            if done:
                yield emitted(done)
        if conv is not None:
            yield emitted([ended()])

    return events.repartition("conv").sortWithinPartitions("conv", "place", "kind").mapInArrow(
        run, "conv string, cost bigint, audit string, repaired_sha256 string"
    )


def repaired(found: Repair) -> DataFrame:
    """``(conv, place, slot, edit, role, text)``: the repaired turns in order, deleted rows with null role.

    Inserted turns stand before the row of their place, those at the end behind the last one.
    """
    both = found.turns.join(found.edits.drop("conv"), "place")
    # State after the inserted turns: they alternate.
    turn = lambda k: F.when(
        (F.col("state") == 2) == (k % 2 == 0), "assistant"
    ).otherwise("user")
    state = F.col("state")
    ahead = F.transform(
        F.when(F.col("inserts") > 0, F.sequence(F.lit(0), F.col("inserts") - 1)).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(k.alias("slot"), F.lit("I").alias("edit"), turn(k).alias("role"), F.lit("").alias("text")),
    )
    role = F.when(F.col("action") == "K", F.col("role")).when(F.col("action") == "R", turn(F.col("inserts")))
    own = F.struct(
        F.col("inserts").alias("slot"), F.col("action").alias("edit"), role.alias("role"),
        F.when(F.col("action") != "D", F.col("text")).alias("text"),
    )
    fitting = F.when((state == 2) == (F.col("inserts") % 2 == 0), 3).otherwise(2)
    kept = F.when(F.startswith("role", F.lit("s")), 1).when(F.startswith("role", F.lit("u")), 2).otherwise(3)
    unmoved = F.when(F.col("inserts") == 0, state).otherwise(F.when((state == 2) == (F.col("inserts") % 2 == 1), 3).otherwise(2))
    after = F.when(F.col("action") == "R", fitting).when(F.col("action") == "K", kept).otherwise(unmoved)
    last = F.col("place") == F.col("end")
    missing = F.when(last & (after == 2), F.array(F.lit("assistant"))).when(
        last & (after == 1), F.array(F.lit("user"), F.lit("assistant"))
    ).otherwise(F.array().cast("array<string>"))
    behind = F.transform(missing, lambda r, k: F.struct((F.col("inserts") + 1 + k).alias("slot"), F.lit("I").alias("edit"), r.alias("role"), F.lit("").alias("text")))
    ends = written(found.turns.groupBy("conv").agg(F.max("place").alias("end")), "ends")
    return both.join(ends, "conv").select("conv", "place", F.inline(F.concat(ahead, F.array(own), behind)))


def report(conversations: DataFrame, rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per id of ``conversations``: faults and repair of its ``rows``.

    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``. ``gaps``
    are turn numbers that are missing between the least and the largest, nulls ignored. An id without rows has
    zeros, an empty audit and the hash of an empty text. A null id is one conversation.
    """
    found = repair(rows, chunk)
    turns = found.faults.where("turn is not null").groupBy("conv", "turn").count()
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = turns.groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count(F.lit(1)).alias("n")).select(
        "conv", (wide("high") - wide("low") + 1 - wide("n")).try_cast("bigint").alias("gaps")
    )
    counts = found.faults.groupBy("conv").agg(*[
        F.count_if(F.col("fault") == k).alias(c) for k, c in ((BLANK, "blank"), (REPEATED, "duplicate"), (TRUNCATED, "truncated"))
    ])
    following = found.units.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("first").alias("next"))
    met = F.expr("last = 0 and next = 1 or last = 1 and next = 2 or last = 2 and next = 1")
    illegal = found.units.join(following, ["conv", "chunk"], "left").groupBy("conv").agg(
        F.sum(F.col("illegal") + F.when(F.col("next").isNotNull() & ~met, 1).otherwise(0)).alias("illegal")
    )
    ids = conversations.select("conv_id").distinct().withColumn(
        "conv", F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    )
    joined = ids
    for part in (gaps, counts, illegal, digests(found)):
        joined = joined.join(part, "conv", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
