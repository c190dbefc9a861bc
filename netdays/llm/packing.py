"""Packing token sequences: linear grouping for long pieces, best fit for short ones.

The plan is made from the histogram of lengths, which has at most ``capacity``
entries whatever the corpus. Long pieces are sorted and cut into groups of equal
cardinality; each group counts with its largest length, so few sizes are left.
The linear program over configurations of those sizes (how many of each fill a
sequence) is solved by column generation and rounded down. Actual pieces replace
the rounded ones, and what is left goes, longest first, where it fits best. All
of it moves runs of equal pieces into runs of equal sequences: the plan is a list
of such moves, and each piece finds its place from its length and its rank among
the pieces of that length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from netdays.llm.common import lean, remembered, texts, written

# Words of each of two generations that one worker remembers.
WORDS = 750_000
# Longest word that is remembered.
SHORT = 64
# New words that the tokenizer takes at once: what it returns for each is far larger than its ids.
ABREAST = 10_000
# Letters that are lower case already, and the marks that often follow a word.
plain_word = re.compile("([a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?%&*$#|]*)").fullmatch


class WordTokenizer:
    """Ids of a tokenizer that drops white space and never looks across it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        # The model spells bytes as visible characters: those that are none, from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in shown)}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, items: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(items, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]

    def _new(self, words: list[str]) -> list[bytes]:
        """Ids of new words. Letters and the marks that end them are apart for the tokenizer,
        so letters that are lower case already go straight to its merges."""
        cut = [plain_word(w) for w in words]
        rest = [w if c is None else c[2] for w, c in zip(words, cut)]
        odd = list({r for r in rest if r})
        ids = dict(zip(odd, self._encode(odd))) | {"": b""}
        out, merge, pack = [], self.model.tokenize, struct.pack
        for c, r in zip(cut, rest):
            if c is None:
                out.append(ids[r])
                continue
            letters = c[1]
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self.visible)
            found = [t.id for t in merge(letters)]
            out.append(pack(f"<{len(found)}I", *found) + ids[r])
        return out

    def _words(self, text: str) -> list[str] | None:
        """The words of a text; None if only the whole text can be encoded."""
        if any(s in text for s in ("\x1c", "\x1d", "\x1e", "\x1f", *self.special)):
            return None  # blanks here, but not for the tokenizer; or a token that may hold any character
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split()
        # The tokenizer lower-cases itself; these letters have one lower case each, and no marks to compose.
        lowered = text.lower()
        return lowered.split() if not any(s in lowered for s in self.special) else text.split()

    def encode(self, batch: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self._words(t) for t in batch]
        wanted = set()
        for words in split:
            if words is not None:
                wanted.update(words)
        if len(self.words) + len(wanted) > WORDS:
            self.older, self.words = self.words, {}
        kept = {w: self.older[w] for w in wanted & self.older.keys() if w not in self.words}
        self.words.update(kept)
        missing = list(wanted - self.words.keys())
        long = {w for w in missing if len(w) > SHORT}
        for at in range(0, len(missing), ABREAST):
            part = missing[at:at + ABREAST]
            self.words.update(zip(part, self._new(part)))
        out = [
            b"".join(map(self.words.__getitem__, words)) if words is not None else self._encode([text])[0]
            for words, text in zip(split, batch)
        ]
        for word in long:
            del self.words[word]
        return out


def tokenizer(path: str) -> WordTokenizer:
    return remembered(("packing", path), lambda: WordTokenizer(path))


def tokenized(docs: DataFrame, path: str, capacity: int, end: int, digest: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``(doc_id, piece, start, length, ids, part, nth)``.

    With ``digest``, ``ids_crc32`` takes the place of ``ids``, which then never leave the task.
    A document's ids are those of its text (null is empty), then ``end``. Every row
    of ``docs`` counts by itself, also where ids repeat or are null. ``nth`` is a
    piece's rank among the pieces of its length in its ``part``; the table must be
    written before it is packed, as parts hold only as long as they are not computed anew.
    """
    held = "ids_crc32" if digest else "ids"
    names = ["doc_id", "piece", "start", "length", held, "part", "nth"]
    last = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = tokenizer(path), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for row, ids in enumerate(words.encode(texts(batch))):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    length = len(cut) // 4
                    rows.append((row, piece, at // 4, length, zlib.crc32(cut) if digest else cut, int(ranks[length])))
                    ranks[length] += 1
            row, piece, start, length, cut, nth = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(cut, pa.int64() if digest else pa.binary()),
                    pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64()),
                ],
                names,
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        lean(run, ("packing", path)), f"doc_id {kind}, piece int, start bigint, length bigint, {held} {'bigint' if digest else 'binary'}, part int, nth bigint"
    )


@dataclass(frozen=True)
class Settings:
    """Pieces longer than ``capacity / p`` are long, for the ``p`` of ``parts`` that needs the
    fewest sequences; they are cut into ``groups`` groups."""

    parts: tuple[int, ...] = (2, 3, 4)
    groups: int = 64
    rounds: int = 2_000


def linear_groups(long: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Runs ``(length, count)``, longest first, cut into groups of equal cardinality."""
    total = sum(n for _, n in long)
    each = -(-total // groups) if total else 1
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for length, count in long:
        while count:
            if not room:
                out.append([])
                room = each
            taken = min(room, count)
            out[-1].append((length, taken))
            room -= taken
            count -= taken
    return [g for g in out if g]


def _best_configuration(value: np.ndarray, sizes: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """How often to take each size, within the capacity, for the largest sum of values."""
    best = np.zeros(capacity + 1)
    taken: list[np.ndarray] = []
    for _ in range(most):
        better, choice = best.copy(), np.full(capacity + 1, -1)
        for g, size in enumerate(sizes):
            if value[g] <= 0:
                continue
            sums = best[: capacity + 1 - size] + value[g]
            up = sums > better[size:] + 1e-12
            better[size:][up] = sums[up]
            choice[size:][up] = g
        taken.append(choice)
        best = better
    configuration, room = np.zeros(len(sizes), int), capacity
    for choice in reversed(taken):
        if choice[room] >= 0:
            configuration[choice[room]] += 1
            room -= sizes[choice[room]]
    return configuration


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how many whole sequences take each, from the relaxed optimum."""
    if not sizes:
        return []
    size, wanted = np.array(sizes), np.array(demand, float)
    most = capacity // min(sizes)
    columns = np.diag(capacity // size).astype(float)
    for _ in range(rounds):
        inverse = np.linalg.inv(columns)
        amounts, prices = inverse @ wanted, inverse.sum(axis=0)
        entering = _best_configuration(prices, size, capacity, most)
        if prices @ entering <= 1 + 1e-9:
            break
        step = inverse @ entering
        ratio = np.full(len(step), np.inf)
        ratio[step > 1e-9] = np.maximum(amounts[step > 1e-9], 0) / step[step > 1e-9]
        columns[:, int(ratio.argmin())] = entering
    amounts = np.linalg.inv(columns) @ wanted
    return [(columns[:, k].round().astype(int), int(np.floor(x + 1e-7))) for k, x in enumerate(amounts) if x >= 1 - 1e-7]


class Plan:
    """Moves of runs of equal pieces into runs of equal sequences."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.moves: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, per sequence, offset
        self.ranks: dict[int, int] = {}
        self.sequences = 0
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first, sequences)

    def put(self, length: int, per: int, first: int, count: int, offset: int) -> None:
        rank = self.ranks.get(length, 0)
        self.moves.append((length, rank, first, per, offset))
        self.ranks[length] = rank + per * count

    def new(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def fill(self, parts: list[tuple[int, int]], count: int) -> None:
        """``count`` new sequences, each with the given pieces ``(length, how many)``."""
        first, offset = self.new(count), 0
        for length, per in parts:
            self.put(length, per, first, count, offset)
            offset += length * per
        self.open[self.capacity - offset].append((first, count))

    def best_fit(self, length: int, count: int) -> None:
        room = length
        while count:
            while room <= self.capacity and not self.open[room]:
                room += 1
            if room > self.capacity:
                self.open[self.capacity].append((self.new(-(-count // (self.capacity // length))), -(-count // (self.capacity // length))))
                room = self.capacity
            first, sequences = self.open[room].pop()
            per = room // length
            full = min(sequences, count // per)
            if full:
                self.put(length, per, first, full, self.capacity - room)
                self.open[room - per * length].append((first, full))
                first, sequences, count = first + full, sequences - full, count - full * per
            if sequences and count < per:
                if count:
                    self.put(length, count, first, 1, self.capacity - room)
                    self.open[room - count * length].append((first, 1))
                    first, sequences, count = first + 1, sequences - 1, 0
            if sequences:
                self.open[room].append((first, sequences))


def plan(histogram: dict[int, int], capacity: int, settings: Settings = Settings()) -> Plan:
    """Places for as many pieces of each length as the histogram counts."""
    plans = (_plan(histogram, capacity, max(1, capacity // parts), settings) for parts in settings.parts)
    return min(plans, key=lambda p: p.sequences)


def _plan(histogram: dict[int, int], capacity: int, border: int, settings: Settings) -> Plan:
    runs = sorted(((length, n) for length, n in histogram.items() if n and length), reverse=True)
    groups = linear_groups([r for r in runs if r[0] > border], settings.groups)
    sizes, members = [], []
    for group in groups:  # groups that round to one size are one
        if sizes and sizes[-1] == group[0][0]:
            members[-1] += group
        else:
            sizes.append(group[0][0])
            members.append(list(group))
    out = Plan(capacity)
    demand = [sum(n for _, n in m) for m in members]
    queues = [m[::-1] for m in members]  # longest at the end

    def take(g: int, wanted: int) -> list[tuple[int, int]]:
        got = []
        while wanted:
            length, n = queues[g].pop()
            used = min(n, wanted)
            got.append((length, used))
            if n > used:
                queues[g].append((length, n - used))
            wanted -= used
        return got

    for configuration, count in configurations(sizes, demand, capacity, settings.rounds):
        used = [(g, int(m)) for g, m in enumerate(configuration) if m]
        while count:
            # As many sequences as one run of each group fills alike; at a run's end, one mixed sequence.
            alike = min([count, *(queues[g][-1][1] // m for g, m in used)])
            if alike:
                parts = []
                for g, m in used:
                    (length, _), = take(g, m * alike)
                    parts.append((length, m))
                out.fill(parts, alike)
                count -= alike
            else:
                out.fill([run for g, m in used for run in take(g, m)], 1)
                count -= 1
    rest: dict[int, int] = {length: n for length, n in runs if length <= border}
    for queue in queues:
        for length, n in queue:
            rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        out.best_fit(length, rest[length])
    return out


def pack(pieces: DataFrame, capacity: int, settings: Settings = Settings()) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a written table of ``tokenized`` rows.

    Sequences have no gaps. The histogram, one row per length, is all that the
    driver sees; the plan made from it depends on lengths and not on the number of rows.
    """
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = plan(histogram, capacity, settings)
    moves = np.array(sorted(found.moves), np.int64).reshape(-1, 5)
    starts = np.searchsorted(moves[:, 0], np.arange(capacity + 2))
    shared = spark.sparkContext.broadcast((moves, starts))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "ranks")
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    ranked = pieces.join(base, ["length", "part"]).select(*kept, (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, starts = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                mine = length == one
                at[mine] = starts[one] + np.searchsorted(moves[starts[one]:starts[one + 1], 1], rank[mine], "right") - 1
            _, first, sequence, per, offset = moves[at].T
            done = rank - first
            columns = [batch.column(c) for c in kept] + [
                pa.array(sequence + done // per), pa.array(offset + done % per * length)
            ]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def sequences(placed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: the packed ids, one row per sequence of bounded size."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("all")).select(
        "sequence_id", "n_tokens", F.expr("aggregate(all, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")
    )
