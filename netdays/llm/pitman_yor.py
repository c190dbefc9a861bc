"""Language-model scores by a hierarchical Pitman-Yor process.

Every context, which is the whole previous word, is a restaurant whose dishes are
words; all of them share one parent, the restaurant without context, whose own
parent is uniform over the known words and one unknown. A Gibbs sweep takes the
customers of each dish out and seats them again, each by a draw of its own, given the
tables of the restaurant's other dishes and the parent's chances that the last sweep left:
the first customer opens a table, each further one joins the dish's tables or opens
one, and every table sends a customer to the parent, which is reseated likewise. The
predictive probabilities of the sweeps after the first ones are averaged.

Dishes lie in units by their word, those of common words in several units by their context.
What a sweep has to know of a word or a context beyond the unit (tables, customers of the
parent) lies in the unit that is the word's home: units send what they seated there, one
number for each key, and are told the sums. A dish of one customer always has one table, so only
the others take part. No context and no word has to fit into one task, and the driver holds
totals alone, and the codes of common words. Draws are hashes of word, context, sweep and
customer, so a lost task repeats its draws exactly. Texts that are scored send their pairs of
words to the units; pairs whose context a unit has not seen are joined with the words and contexts.
"""

from __future__ import annotations

import gc
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.llm import suffixes
from netdays.llm.common import CHUNK, by_size, lean, new_scratch_path, texts, written

START = np.uint64(0x57A7)  # the context of a first word; like the end no word's hash, but for one in 2^64
END = np.uint64(0x0E4D)

TOKENS = 1_500_000
# Text of one unit, and messages of one Arrow batch, in bytes.
UNIT = 8 << 20
BATCH = 8 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Units of text that are looked at to find common words, and how many have a code; neither changes a result.
LOOKED_AT = 8
CODES = 0xFFFF
# The first customers of all dishes are seated abreast; later ones in runs of so many at most.
ABREAST = 32
CUSTOMERS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``frequent`` is the share of all tokens that a word has at least whose dishes several units may hold."""

    sweeps: int = 6
    burn_in: int = 2
    strength: float = 5.0
    parent_strength: float = 50.0
    frequent: float = 2e-5
    seed: int = 3


def tokens(rows: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, word and context of every token, in parts of bounded size: words, then each row's end."""
    pieces: list[tuple[int, bytes, bool]] = []
    for row, text in enumerate(rows):
        octets = text.encode("utf-8", "surrogatepass").lower()
        at = 0
        while True:
            end = at + CHUNK
            while end < len(octets) and octets[end] not in b" \t\n\x0b\x0c\r":
                end += 1
            pieces.append((row, octets[at:end], end >= len(octets)))
            at = end
            if at >= len(octets):
                break
    carried: dict[int, np.uint64] = {}
    for low, high in by_size(pieces, lambda p: len(p[1]) + 1):
        part = pieces[low:high]
        octets = np.frombuffer(b"\n".join([p[1] for p in part]), np.uint8)
        offsets = np.cumsum([0] + [len(p[1]) + 1 for p in part[:-1]])
        hashes, starts, ends = suffixes.word_hashes(octets)
        piece = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(piece, minlength=len(part))
        firsts = np.cumsum(counts) - counts
        context = np.empty(len(hashes), np.uint64)
        context[1:] = hashes[:-1]
        at_end = np.empty(len(part), np.uint64)
        for k, (row, _, whole) in enumerate(part):
            previous = carried.pop(row, START)
            if counts[k]:
                context[firsts[k]] = previous
                previous = hashes[firsts[k] + counts[k] - 1]
            at_end[k] = previous
            if not whole:
                carried[row] = previous
        closing = np.array([k for k, p in enumerate(part) if p[2]], np.int64)
        where = (firsts + counts)[closing]
        row = np.array([p[0] for p in part], np.int64)
        yield (
            np.insert(row[piece], where, row[closing]), np.insert(hashes, where, END),
            np.insert(context, where, at_end[closing]),
        )


# A message goes to a unit and says what it is about; its parts are packed arrays.
MESSAGE = "to int, kind int, origin bigint, parts array<binary>"
LONE, SEVERAL, STATE, WORDS, CONTEXTS, ASKED_WORDS, ASKED_CONTEXTS, TOLD_WORDS, TOLD_CONTEXTS, SUMS, TOKEN_PAIRS, ROW, ROW_SUMS, UNMET = range(14)
Message = tuple[int, int, int, list[bytes]]
# Rows whose sums meet in one place, and what is summed.
ROWS = 1 << 13
NUMBERS = ("n_tokens", "n_known", "base", "score")
Mail = dict[int, list[tuple[int, list[bytes]]]]


def _packed(values: np.ndarray) -> bytes:
    """Counts, most of them below 255: a byte each, and the others in full."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<u8").tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    values = np.frombuffer(data, np.uint8, size).astype(np.int64)
    large = values == 255
    if large.any():
        values[large] = np.frombuffer(data, "<u8", offset=size)
    return values


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Small numbers byte by byte, the lowest bytes of all first."""
    return values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()


def _from_planes(data: bytes, size: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    octets = np.frombuffer(data, np.uint8, size * width).reshape(width, size)
    return np.ascontiguousarray(octets.T).view(kind).ravel()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted values lie among sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass(frozen=True)
class Layout:
    """How dishes are dealt over units. ``common`` words are sorted, ``code`` is the place of each
    among ``by_code``, and their contexts are dealt over ``spread`` units."""

    units: int
    common: np.ndarray
    code: np.ndarray
    by_code: np.ndarray
    spread: np.ndarray

    def unit(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of pairs, those of a word one after the other."""
        starts = _starts(word)
        sizes = np.diff(np.append(starts, len(word)))
        own = word[starts]
        at, common = _places(self.common, own)
        pieces = np.ones(len(own), np.uint64)
        pieces[common] = self.spread[at[common]]
        unit = np.repeat(self._mixed(own, 1) % np.uint64(self.units), sizes)
        dealt = np.flatnonzero(np.repeat(pieces > 1, sizes))
        step = self._mixed(context[dealt], 2) % np.repeat(pieces, sizes)[dealt]
        unit[dealt] = (unit[dealt] + step) % np.uint64(self.units)
        return unit.astype(np.int32)

    def spread_out(self, word: np.ndarray) -> np.ndarray:
        """Words of which one unit may know nothing though another one does."""
        at, common = _places(self.common, word)
        common[common] = self.spread[at[common]] > 1
        return common

    def homes(self, keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Order by home, and for each home its unit and range. Homes are few, so that messages are not small."""
        home = (self._mixed(keys, 3) % np.uint64(1 + 3 * math.isqrt(self.units))).astype(np.int32)
        order = np.argsort(home, kind="stable")
        starts = _starts(home[order])
        return order, list(zip(home[order][starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]))

    def _mixed(self, keys: np.ndarray, salt: int) -> np.ndarray:
        return suffixes._mixed(keys + np.uint64(salt * 0x9E3779B9)) >> np.uint64(8)

    def coded(self, hashes: np.ndarray) -> bytes:
        at, common = _places(self.common, hashes)
        code = np.full(len(hashes), 0xFFFF)
        code[common] = self.code[at[common]]
        return len(hashes).to_bytes(8, "little") + _planes(code, "<u2") + hashes[~common].astype("<u8").tobytes()

    def decoded(self, data: bytes) -> np.ndarray:
        size = int.from_bytes(data[:8], "little")
        code = _from_planes(data[8:8 + 2 * size], size, "<u2")
        hashes, common = np.empty(size, np.uint64), code != 0xFFFF
        hashes[common] = self.by_code[code[common]]
        hashes[~common] = np.frombuffer(data, "<u8", offset=8 + 2 * size)
        return hashes

    def pack(self, word: np.ndarray, context: np.ndarray, *counts: np.ndarray) -> list[bytes]:
        """Dishes in the order of their words."""
        starts = _starts(word)
        sizes = np.diff(np.append(starts, len(word)))
        return [self.coded(word[starts]), _packed(sizes), self.coded(context), *map(_packed, counts)]

    def unpack(self, parts: list[bytes], counts: int = 1) -> tuple[np.ndarray, ...]:
        words = self.decoded(parts[0])
        word = np.repeat(words, _unpacked(parts[1], len(words)))
        return word, self.decoded(parts[2]), *(_unpacked(p, len(word)) for p in parts[3:3 + counts])


def _squeezed(part: bytes) -> bytes:
    return len(part).to_bytes(4, "little") + pa.compress(part, codec="zstd", asbytes=True)


def _opened_up(part: bytes) -> bytes:
    return pa.decompress(part[4:], int.from_bytes(part[:4], "little"), codec="zstd", asbytes=True)


def _batches(messages: Iterator[Message]) -> Iterator[pa.RecordBatch]:
    """Messages in batches of bounded size."""
    held: list[Message] = []
    size = 0

    def batch() -> pa.RecordBatch:
        to, kind, origin, parts = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(to, pa.int32()), pa.array(kind, pa.int32()), pa.array(origin, pa.int64()), pa.array(parts, pa.list_(pa.binary()))],
            ["to", "kind", "origin", "parts"],
        )

    for to, kind, origin, parts in messages:
        held.append((to, kind, origin, [_squeezed(p) for p in parts]))
        size += 100 + sum(map(len, held[-1][3]))
        if size >= BATCH:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _mail(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Mail]]:
    """The messages of one unit after the other, from rows sorted by unit, kind and origin."""
    at, mail = None, defaultdict(list)
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("to", "kind", "origin", "parts")]
        for to, kind, origin, parts in zip(*columns):
            if to != at and at is not None:
                yield at, mail
                mail = defaultdict(list)
            at = to
            mail[kind].append((origin, [_opened_up(p) for p in parts]))
    if at is not None:
        yield at, mail


def _at_units(messages: DataFrame, run: Callable[[int, Mail], Iterator[Message]]) -> DataFrame:
    """What units answer to their messages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(m for unit, mail in _mail(batches) for m in run(unit, mail))

    return _delivered(messages).mapInArrow(lean(task), MESSAGE)


def _delivered(messages: DataFrame) -> DataFrame:
    return messages.repartition("to").sortWithinPartitions("to", "kind", "origin")


class _Table:
    """Written messages, a folder for each kind."""

    def __init__(self, messages: DataFrame, label: str, schema: str = MESSAGE):
        self.spark = messages.sparkSession
        self.path = new_scratch_path(self.spark, label)
        _let_go(self.spark)
        before = self.spark.conf.get(BATCH_BYTES)
        self.spark.conf.set(BATCH_BYTES, str(2 * BATCH))
        try:
            messages.write.partitionBy("kind").parquet(self.path)
        finally:
            self.spark.conf.set(BATCH_BYTES, before)
        self.rows = self.spark.read.schema(schema).parquet(self.path)

    def of(self, *kinds: int) -> DataFrame:
        return self.rows.where(F.col("kind").isin(*kinds)).select("to", "kind", "origin", "parts")

    def sums(self) -> dict[int, np.ndarray]:
        """Some numbers of each unit, by unit."""
        rows = self.of(SUMS).collect()
        return {r["origin"]: np.frombuffer(_opened_up(bytes(r["parts"][0])), np.float64) for r in rows}

    def drop(self, *kinds: int) -> None:
        """Remove messages that have been answered."""
        for kind in kinds:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/kind={kind}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _let_go(spark: SparkSession) -> None:
    """Have Spark remove shuffles that are done with, which may be as large as the input."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Place of the row in the partition, word and context of tokens, in parts of bounded size."""
    held: list[tuple] = []
    size = place = 0
    for batch in batches:
        for row, word, context in tokens(texts(batch)):
            held.append((row + place, word, context))
            size += len(word)
            if size >= TOKENS:
                chunk = tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
                yield chunk
                del chunk
        place += batch.num_rows
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _laid_out(training: DataFrame, settings: Settings) -> Layout:
    """Units by the size of the texts; common words by those of a few units' texts, at most ``CODES``."""
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = 1 + size // UNIT

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, word, _ in _chunks(batches):
            words, n = np.unique(word, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    few = training.where(F.pmod(F.xxhash64("text"), F.lit(1 + units // LOOKED_AT)) == 0).select("text")
    counts = written(few.mapInArrow(counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "looked-at")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(CODES).collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    share = np.array([r["n"] for r in rows], float) / max(1, total)
    spread = np.where(share >= settings.frequent, 1 + 4 * units * share, 1)
    order = np.argsort(words)
    return Layout(units, words[order], order, words, spread[order].astype(np.uint64))


def _to_units(layout: Layout, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by unit, with equal pairs one after the other; for each unit its range."""
    order = _by_pair(word, context)
    unit = layout.unit(word[order], context[order])
    if layout.units <= 1 << 16:
        unit = unit.astype(np.uint16)  # sorted by radix
    by_unit = np.argsort(unit, kind="stable")
    unit = unit[by_unit]
    starts = _starts(unit)
    return order[by_unit], list(zip(unit[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(word)]))


def _by_pair(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """An order with equal pairs, and but for rare chances equal words, one after the other."""
    pair = suffixes._mixed(context ^ (word << np.uint64(1)))
    key = (word >> np.uint64(40) << np.uint64(40)) | (pair >> np.uint64(24))
    order = np.argsort(key)
    key, word, context = key[order], word[order], context[order]
    same = key[1:] == key[:-1]
    if (same & ((word[1:] != word[:-1]) | (context[1:] != context[:-1]))).any():
        return order[np.lexsort((context, word))]
    return order


def _asks(layout: Layout, unit: int, word: np.ndarray, context: np.ndarray, seats: np.ndarray) -> Iterator[Message]:
    """To the homes of words and contexts: how many tables their dishes have here."""
    yield from _asked(layout, unit, ASKED_WORDS, *np.unique(word, return_inverse=True), seats)
    yield from _asked(layout, unit, ASKED_CONTEXTS, *np.unique(context, return_inverse=True), seats)


def _asked(layout: Layout, unit: int, kind: int, keys: np.ndarray, place: np.ndarray, seats: np.ndarray) -> Iterator[Message]:
    sums = np.bincount(place, seats, len(keys)).astype(np.int64)
    order, ranges = layout.homes(keys)
    for home, a, b in ranges:
        some = order[a:b]
        yield home, kind, unit, [layout.coded(keys[some]), _packed(sums[some])]


def _told(layout: Layout, mail: Mail, kind: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys that were asked about, each row's place among them, and what their homes tell."""
    keys, place = np.unique(key, return_inverse=True)
    order, ranges = layout.homes(keys)
    answers = [[_unpacked(p, b - a) for p in parts] for (_, a, b), (_, parts) in zip(ranges, mail[kind], strict=True)]
    columns = []
    for some in zip(*answers):
        column = np.empty(len(keys), np.int64)
        column[order] = np.concatenate(some)
        columns.append(column)
    return keys, place, columns


def _joined(layout: Layout, mail: Mail, *kinds: int) -> tuple[np.ndarray, ...]:
    """Dishes of some messages, equal ones one after the other."""
    messages = [layout.unpack(parts) for kind in kinds for _, parts in mail[kind]]
    word, context, n = (np.concatenate(x) for x in zip(*messages))
    order = _by_pair(word, context)
    return word[order], context[order], n[order]


def _counted(training: DataFrame, layout: Layout) -> _Table:
    """Messages: each unit's dishes with their customers, and for the homes the sums by word and by context."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[Message]:
        for _, word, context in _chunks(batches):
            order, ranges = _to_units(layout, word, context)
            word, context = word[order], context[order]
            for unit, a, b in ranges:
                starts = a + _starts(word[a:b], context[a:b])
                yield unit, LONE, 0, layout.pack(word[starts], context[starts], np.diff(np.append(starts, b)))
            del word, context, order

    def met(unit: int, mail: Mail) -> Iterator[Message]:
        word, context, n = _joined(layout, mail, LONE)
        starts = _starts(word, context)
        word, context, n = word[starts], context[starts], np.add.reduceat(n, starts)
        several = n > 1
        for kind, some in ((LONE, ~several), (SEVERAL, several)):
            if some.any():
                yield unit, kind, 0, layout.pack(word[some], context[some], n[some])
        for kind, key in ((WORDS, word), (CONTEXTS, context)):
            keys, place = np.unique(key, return_inverse=True)
            sums = [np.bincount(place, x, len(keys)).astype(np.int64) for x in (n, n == 1, np.ones(len(n)))]
            order, ranges = layout.homes(keys)
            for home, a, b in ranges:
                some = order[a:b]
                yield home, kind, unit, [layout.coded(keys[some]), *(_packed(x[some]) for x in sums)]
        yield from _asks(layout, unit, word[several], context[several], np.ones(several.sum()))
        yield 0, SUMS, unit, [np.array([n.sum(), (n == 1).sum(), (n == 2).sum()], float).tobytes()]

    sent = training.select("text").mapInArrow(lean(lambda batches: _batches(pairs(batches))), MESSAGE)
    return _Table(_at_units(sent, met), "dishes")


@dataclass(frozen=True)
class Totals:
    """What a sweep leaves: customers and tables of the parent."""

    parent_customers: float
    parent_tables: float


@dataclass(frozen=True)
class Corpus:
    tokens: int
    words: int
    discount: float
    parent_discount: float


def _uniform(key: np.ndarray, customer: np.ndarray | int) -> np.ndarray:
    """A draw below one for a customer of each dish, made of both alone."""
    turn = np.asarray(customer).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (suffixes._mixed(key ^ turn) >> np.uint64(11)) * 2.0**-53


def seated(
    count: np.ndarray, chance: np.ndarray, discount: float, key: np.ndarray, per_table: np.ndarray | float = 0.0
) -> np.ndarray:
    """Tables drawn for dishes with ``count`` customers, seated one by one.

    A customer opens a table by the weight ``chance``, and ``per_table`` more for each table of
    the dish, against one for each customer before less the discount of each table. Every
    customer has a draw, however many there are.
    """
    tables = np.minimum(count, 1).astype(np.float64)
    per_table = np.broadcast_to(np.asarray(per_table, np.float64), chance.shape)
    going = np.flatnonzero(count > 1)
    for done in range(1, ABREAST):
        t, uniform = tables[going], _uniform(key[going], done)
        weight = chance[going] + per_table[going] * t
        tables[going] += uniform * (weight + done - discount * t) < weight
        going = going[count[going] > done + 1]
        if not len(going):
            return tables
    done = ABREAST
    while len(going):
        size = np.minimum(count[going], done + min(done, CUSTOMERS)) - done
        part = np.cumsum(size) // CUSTOMERS
        for some in np.split(np.arange(len(going)), np.flatnonzero(part[1:] != part[:-1]) + 1):
            dish = going[some]
            tables[dish] += _opened(
                size[some], done, tables[dish], chance[dish], per_table[dish], discount, key[dish]
            )
        done += min(done, CUSTOMERS)
        going = going[count[going] > done]
    return tables


def _opened(size, done: int, tables, chance, per_table, discount: float, key) -> np.ndarray:
    """Tables that the next ``size`` customers of each dish open after ``done`` others.

    The tables before a customer depend on the draws before it. The more there are, the likelier
    is a new one, so a customer who would open none if all before had done so opens none. For the
    others the tables are counted again with what was found until nothing changes, which
    is where seating one after the other leads, as the first customer's count is right
    from the start, the second's after one round, and so on.
    """
    dish = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(dish)) - np.repeat(np.cumsum(size) - size, size)
    uniform = _uniform(key[dish], done + place)

    def opens(dish, before, place, uniform):
        t = tables[dish] + before
        weight = chance[dish] + per_table[dish] * t
        return uniform * (weight + done + place - discount * t) < weight

    may = np.flatnonzero(opens(dish, place, place, uniform))
    dish, place, uniform = dish[may], place[may], uniform[may]
    first = np.searchsorted(dish, np.arange(len(size)))[dish]
    found = np.zeros(len(dish), bool)
    while True:
        all_before = np.cumsum(found) - found
        again = opens(dish, all_before - all_before[first], place, uniform)
        if (again == found).all():
            return np.bincount(dish, found, minlength=len(size))
        found = again


def _parent(corpus: Corpus, totals: Totals, settings: Settings, customers, tables):
    """The parent's chance of words with given customers and tables."""
    rest = (settings.parent_strength + corpus.parent_discount * totals.parent_tables) / (corpus.words + 1)
    return (customers - corpus.parent_discount * tables + rest) / (settings.parent_strength + totals.parent_customers)


def _salted(words: np.ndarray, sweep: int, settings: Settings) -> np.ndarray:
    return suffixes._mixed(words + np.uint64((settings.seed * 1_000 + sweep) * 0x1000))


def _begun(layout: Layout, unit: int, mail: Mail) -> Iterator[Message]:
    """At the homes, before the first sweep: each dish and each word has one table."""
    words, contexts = _merged(layout, mail[WORDS]), _merged(layout, mail[CONTEXTS])
    keys, n, lone, dishes = words
    yield unit, WORDS, 0, [layout.coded(keys), *map(_packed, (n, lone, dishes, np.minimum(dishes, 1)))]
    yield unit, CONTEXTS, 0, [layout.coded(contexts[0]), *map(_packed, contexts[1:])]
    yield from _tells(layout, unit, mail[ASKED_WORDS], TOLD_WORDS, keys, dishes, np.minimum(dishes, 1))
    yield from _tells(layout, unit, mail[ASKED_CONTEXTS], TOLD_CONTEXTS, contexts[0], contexts[3])
    numbers = [len(keys), dishes.sum(), (dishes == 1).sum(), (dishes == 2).sum(), len(contexts[0])]
    yield 0, SUMS, unit, [np.array(numbers, float).tobytes()]


def _merged(layout: Layout, messages: list[tuple[int, list[bytes]]]) -> list[np.ndarray]:
    """Sorted keys and the sums of their numbers."""
    if not messages:
        return [np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))]
    parts = [p for _, p in messages]
    each = [layout.decoded(p[0]) for p in parts]
    keys, place = np.unique(np.concatenate(each), return_inverse=True)
    sums = []
    for k in (1, 2, 3):
        values = np.concatenate([_unpacked(p[k], len(own)) for p, own in zip(parts, each)])
        sums.append(np.bincount(place, values, len(keys)).astype(np.int64))
    return [keys, *sums]


def _tells(layout: Layout, unit: int, asked: list, kind: int, keys: np.ndarray, *values: np.ndarray) -> Iterator[Message]:
    """To those who asked: numbers of the keys, in the order of the question."""
    for origin, parts in asked:
        at = np.searchsorted(keys, layout.decoded(parts[0]))
        yield origin, kind, unit, [_packed(x[at]) for x in values]


def _held(layout: Layout, mail: Mail, kind: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of a home and their numbers."""
    if not mail[kind]:
        return np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * 4
    parts = mail[kind][0][1]
    keys = layout.decoded(parts[0])
    return keys, [_unpacked(p, len(keys)) for p in parts[1:]]


def _parent(corpus: Corpus, totals: Totals, settings: Settings, customers, tables):
    """The parent's chance of words with given customers and tables."""
    rest = (settings.parent_strength + corpus.parent_discount * totals.parent_tables) / (corpus.words + 1)
    return (customers - corpus.parent_discount * tables + rest) / (settings.parent_strength + totals.parent_customers)


def _reseated(layout: Layout, corpus: Corpus, totals: Totals, settings: Settings, sweep: int, keep: bool):
    """A sweep in the units: the customers of each dish, given the last tables of the others."""

    def run(unit: int, mail: Mail) -> Iterator[Message]:
        if not mail[SEVERAL]:
            return
        word, context, n = layout.unpack(mail[SEVERAL][0][1])
        seats, kept = np.ones(len(n)), np.zeros(len(n), np.int64)
        if mail[STATE]:
            seats, kept = (_unpacked(p, len(n)) for p in mail[STATE][0][1])
        words, w, (customers, tables) = _told(layout, mail, TOLD_WORDS, word)
        parent = _parent(corpus, totals, settings, customers, tables)[w]
        contexts, c, (tables,) = _told(layout, mail, TOLD_CONTEXTS, context)
        key = suffixes._mixed(_salted(word, sweep, settings) + context + np.uint64(1))
        weight = (settings.strength + corpus.discount * (tables[c] - seats)) * parent
        seats = seated(n, weight, corpus.discount, key, corpus.discount * parent).astype(np.int64)
        yield unit, STATE, 0, [_packed(seats), _packed(kept + seats if keep else kept)]
        yield from _asked(layout, unit, ASKED_WORDS, words, w, seats)
        yield from _asked(layout, unit, ASKED_CONTEXTS, contexts, c, seats)

    return run


def _tabled(layout: Layout, corpus: Corpus, totals: Totals, settings: Settings, sweep: int, keep: bool):
    """A sweep in the homes: customers and tables of words in the parent, tables of contexts."""
    base = 1 / (corpus.words + 1)

    def added(keys: np.ndarray, lone: np.ndarray, asked: list) -> np.ndarray:
        sums = lone.copy()
        for _, parts in asked:  # keys are distinct in each
            own = layout.decoded(parts[0])
            sums[np.searchsorted(keys, own)] += _unpacked(parts[1], len(own))
        return sums

    def run(unit: int, mail: Mail) -> Iterator[Message]:
        for _, parts in mail[STATE]:
            yield unit, STATE, 0, parts
        if not mail[WORDS] and not mail[CONTEXTS]:
            return
        keys, (n, lone, _, tables, *samples) = _held(layout, mail, WORDS)
        customers = added(keys, lone, mail[ASKED_WORDS])
        others = totals.parent_tables - tables
        tables = seated(
            customers, (settings.parent_strength + corpus.parent_discount * others) * base,
            corpus.parent_discount, _salted(keys, sweep, settings), np.full(len(keys), corpus.parent_discount * base),
        ).astype(np.int64)
        samples += [customers, tables] if keep else []
        yield unit, WORDS, 0, [layout.coded(keys), *map(_packed, (n, lone, customers, tables, *samples))]
        yield from _tells(layout, unit, mail[ASKED_WORDS], TOLD_WORDS, keys, customers, tables)
        yield 0, SUMS, unit, [np.array([customers.sum(), tables.sum()], float).tobytes()]
        keys, (n, lone, _, *samples) = _held(layout, mail, CONTEXTS)
        tables = added(keys, lone, mail[ASKED_CONTEXTS])
        samples += [tables] if keep else []
        yield unit, CONTEXTS, 0, [layout.coded(keys), *map(_packed, (n, lone, tables, *samples))]
        yield from _tells(layout, unit, mail[ASKED_CONTEXTS], TOLD_CONTEXTS, keys, tables)

    return run


@dataclass(frozen=True)
class Samples:
    """Totals of the sweeps that are averaged, and the tables that hold what they left.

    ``units`` are messages: dishes, their seats and what their words and contexts have;
    ``words`` has ``(word, n, parent)`` and ``contexts`` ``(number, context, back_off)``, one value per sample.
    """

    totals: list[Totals]
    layout: Layout
    units: DataFrame
    words: DataFrame
    contexts: DataFrame


@dataclass(frozen=True)
class Model:
    corpus: Corpus
    samples: Samples
    settings: Settings

    def back_off(self) -> np.ndarray:
        """For each sample and context, by its number, the weight of the parent's chance, as a share of
        the average. All contexts come to the driver: for small corpora."""
        rows = self.samples.contexts.orderBy("number").select("back_off").collect()
        return np.array([r["back_off"] for r in rows], float).reshape(-1, len(self.samples.totals)).T

    def unknown(self) -> np.ndarray:
        """For each context, by its number, the averaged chance of an unknown word."""
        return _unknown(self.corpus, self.samples.totals, self.settings) @ self.back_off()


def _unknown(corpus: Corpus, totals: list[Totals], settings: Settings) -> np.ndarray:
    """The parent's chance of an unknown word in each sample."""
    return np.array([_parent(corpus, t, settings, 0.0, 0.0) for t in totals])


def _parents(corpus: Corpus, totals: list[Totals], settings: Settings, pairs: list[np.ndarray]) -> np.ndarray:
    """The parent's chances of words, a row per word, from customers and tables in each sample."""
    return np.stack([_parent(corpus, t, settings, *pairs[2 * k:2 * k + 2]) for k, t in enumerate(totals)], axis=1)


def _back_offs(corpus: Corpus, settings: Settings, customers: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Weights of the parent's chance, a row per context."""
    return np.stack(
        [(settings.strength + corpus.discount * t) / (settings.strength + customers) / len(tables) for t in tables], axis=1
    )


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def fit(training: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """A model and its words ``(word, n, parent, contexts, seen)`` from rows with ``text``.

    A word's chance in a context is the context's back-off weights times ``parent`` (one value per
    sample) plus ``seen`` of that context, if its number is among ``contexts``. The words are made
    when they are read; scoring takes the model's tables.
    """
    spark = training.sparkSession
    layout = _laid_out(training, settings)
    dishes = _counted(training, layout)
    at_homes = (WORDS, CONTEXTS, ASKED_WORDS, ASKED_CONTEXTS)
    state = _Table(_at_units(dishes.of(*at_homes), partial(_begun, layout)), "begun")
    dishes.drop(*at_homes)
    customers, once, twice = sum(dishes.sums().values(), np.zeros(3))
    by_unit = state.sums()
    count, seated_words, words_once, words_twice, _ = sum(by_unit.values(), np.zeros(5))

    def discount(once: float, twice: float) -> float:
        """As usual from how many are seen once and twice."""
        return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5

    corpus = Corpus(int(customers), int(count), discount(once, twice), discount(words_once, words_twice))
    history = [Totals(float(seated_words), float(count))]
    sweeps = settings.sweeps if count else 0
    skipped = max(0, min(settings.burn_in, sweeps - 1))
    for sweep in range(sweeps):
        known = (layout, corpus, history[-1], settings, sweep, sweep >= skipped)
        mail = dishes.of(SEVERAL).unionByName(state.of(STATE, TOLD_WORDS, TOLD_CONTEXTS))
        sent = _at_units(mail, _reseated(*known))
        after = _Table(_at_units(sent.unionByName(state.of(WORDS, CONTEXTS)), _tabled(*known)), "sweep")
        state.drop(STATE, WORDS, CONTEXTS, TOLD_WORDS, TOLD_CONTEXTS)
        state = after
        history.append(Totals(*(float(x) for x in sum(state.sums().values(), np.zeros(2)))))
    state.drop(TOLD_WORDS, TOLD_CONTEXTS)
    totals = history[1 + skipped:] or history

    def asked(unit: int, mail: Mail) -> Iterator[Message]:
        word, context, n = _joined(layout, mail, LONE, SEVERAL)
        yield from _asks(layout, unit, word, context, np.zeros(len(n)))

    def answered(unit: int, mail: Mail) -> Iterator[Message]:
        keys, (n, _, customers, tables, *samples) = _held(layout, mail, WORDS)
        yield from _tells(layout, unit, mail[ASKED_WORDS], TOLD_WORDS, keys, n, *(samples or [customers, tables]))
        keys, (n, _, tables, *samples) = _held(layout, mail, CONTEXTS)
        yield from _tells(layout, unit, mail[ASKED_CONTEXTS], TOLD_CONTEXTS, keys, n, *(samples or [tables]))

    asks = _at_units(dishes.of(LONE, SEVERAL), asked)
    told = _Table(_at_units(asks.unionByName(state.of(WORDS, CONTEXTS)), answered), "told")
    units = dishes.of(LONE, SEVERAL).unionByName(state.of(STATE)).unionByName(told.of(TOLD_WORDS, TOLD_CONTEXTS))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mail in _mail(batches):
            keys, (n, _, customers, tables, *samples) = _held(layout, mail, WORDS)
            parents = _parents(corpus, totals, settings, samples or [customers, tables])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n), _lists(parents)], ["word", "n", "parent"])

    homes = sorted(by_unit)
    first = dict(zip(homes, np.cumsum([0, *(int(by_unit[h][4]) for h in homes)])))

    def contexts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, mail in _mail(batches):
            keys, (n, _, tables, *samples) = _held(layout, mail, CONTEXTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[unit] + np.arange(len(keys))), pa.array(keys.view(np.int64)),
                 _lists(_back_offs(corpus, settings, n, samples or [tables]))],
                ["number", "context", "back_off"],
            )

    def seen_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, mail in _mail(batches):
            if mail[LONE] or mail[SEVERAL]:
                at = _Unit(layout, corpus, totals, settings, mail)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.words[at.word].view(np.int64)), pa.array(at.contexts[at.context].view(np.int64)), pa.array(at.seen)],
                    ["word", "context", "seen"],
                )

    words = state.of(WORDS).mapInArrow(words_of, "word bigint, n bigint, parent array<double>")
    contexts = state.of(CONTEXTS).mapInArrow(contexts_of, "number bigint, context bigint, back_off array<double>")
    seen = _delivered(units).mapInArrow(seen_of, "word bigint, context bigint, seen double")
    lists = (
        seen.join(contexts.select("context", "number"), "context").groupBy("word")
        .agg(F.sort_array(F.collect_list(F.struct("number", "seen"))).alias("d"))
        .select("word", F.col("d.number").alias("contexts"), F.col("d.seen").alias("seen"))
    )
    return Model(corpus, Samples(totals, layout, units, words, contexts), settings), words.join(lists, "word")


class _Unit:
    """A unit's dishes and all that scoring takes: places of their words and contexts, chances of the parent,
    back-off weights, and what the dish itself adds."""

    def __init__(self, layout: Layout, corpus: Corpus, totals: list[Totals], settings: Settings, mail: Mail):
        none = np.zeros(0, np.int64)
        if not mail[LONE] and not mail[SEVERAL]:
            self.words = self.contexts = np.zeros(0, np.uint64)
            self.n = self.word = self.context = none
            self.parent = self.back_off = np.zeros((0, len(totals)))
            self.seen = np.zeros(0)
            self.order = self.codes = none
            return
        word, context, n = _joined(layout, mail, LONE, SEVERAL)
        self.words, self.word, (self.n, *samples) = _told(layout, mail, TOLD_WORDS, word)
        self.parent = _parents(corpus, totals, settings, samples)
        self.contexts, self.context, (customers, *samples) = _told(layout, mail, TOLD_CONTEXTS, context)
        self.back_off = _back_offs(corpus, settings, customers, samples)
        seats = np.ones(len(n))
        if mail[STATE]:
            several = n > 1
            seats[several] = _unpacked(mail[STATE][0][1][1], several.sum()) / len(totals)
        self.seen = (n - corpus.discount * seats) / (settings.strength + customers[self.context])
        codes = self.word * len(self.contexts) + self.context
        self.order = np.argsort(codes)
        self.codes = codes[self.order]

    def dish(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of dishes by the places of their words and contexts, and which there are."""
        at, found = _places(self.codes, word * len(self.contexts) + context)
        return self.order[at] if len(self.order) else at, found


def scored(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)``, one row per row of ``docs``.

    Scores are sums of log10 probabilities over the words and the end; a null text is
    empty and has the end only. Other columns are not read. ``words`` are those of the model,
    whose tables hold them too.
    """
    corpus, settings, layout, totals = model.corpus, model.settings, model.samples.layout, model.samples.totals
    whole = float(corpus.tokens + corpus.words + 1)
    unknown = _unknown(corpus, totals, settings)
    kind = dict(docs.dtypes)["doc_id"]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = place = TaskContext.get().partitionId() << 40

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal place
            for batch in batches:
                mine.append(with_ids(batch, place))
                place += batch.num_rows
                yield batch

        mine: list[pa.RecordBatch] = []

        def pairs() -> Iterator[Message]:
            for row, word, context in _chunks(rows()):
                origin = int(row[0])  # rows ascend
                order, ranges = _to_units(layout, word, context)
                row, word, context = row[order] - origin, word[order], context[order]
                kind = "<u2" if row.max() < 1 << 16 else "<u4"
                for unit, a, b in ranges:
                    starts = a + _starts(word[a:b], context[a:b])
                    times = np.diff(np.append(starts, b))
                    yield unit, TOKEN_PAIRS, first + origin, [*layout.pack(word[starts], context[starts], times), _planes(row[a:b], kind)]
                del row, word, context, order

        for batch in _batches(pairs()):
            yield from mine
            mine.clear()
            yield with_no_id(batch)
        yield from mine

    id_type: list[pa.DataType] = []

    def with_ids(batch: pa.RecordBatch, place: int) -> pa.RecordBatch:
        """A message for each row, so that every one has a score and its own id."""
        ids = batch.column("doc_id")
        id_type[:] = [ids.type]
        places = place + np.arange(batch.num_rows)
        to = np.array([_to_range(p) for p in places // ROWS * ROWS], np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(to), pa.array(np.full(len(places), ROW, np.int32)), pa.array(places),
             pa.nulls(len(places), pa.list_(pa.binary())), ids],
            ["to", "kind", "origin", "parts", "doc_id"],
        )

    def with_no_id(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = pa.nulls(batch.num_rows, id_type[0])
        return pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "doc_id"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        own: list[pa.RecordBatch] = []

        def summed() -> Iterator[Message]:
            """What rows have here, in ranges of neighbouring rows."""
            place, *values = (np.concatenate(x) for x in zip(*held))
            held.clear()
            places, at = np.unique(place, return_inverse=True)
            n, known, base, score = (np.bincount(at, v, len(places)) for v in values)
            ranges = places // ROWS
            starts = _starts(ranges)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(places)]):
                first = int(ranges[a]) * ROWS
                counts = (_packed(x[a:b].astype(np.int64)) for x in (n, known))
                sums = (x[a:b].astype(np.float64).tobytes() for x in (base, score))
                yield _to_range(first), ROW_SUMS, first, [_planes(places[a:b] - first, "<u4"), *counts, *sums]

        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                id_type[:] = [batch.column("doc_id").type]
                is_row = pc.equal(batch.column("kind"), ROW)
                own.append(batch.filter(is_row))
                yield batch.filter(pc.invert(is_row))

        def messages() -> Iterator[Message]:
            for _, mail in _mail(others()):
                yield from looked_up(mail)
                if sum(len(h[0]) for h in held) >= TOKENS:
                    yield from summed()
            if held:
                yield from summed()

        def looked_up(mail: Mail) -> Iterator[Message]:
            if not mail[TOKEN_PAIRS]:
                return
            at = _Unit(layout, corpus, totals, settings, mail)
            dish_chance = (at.back_off[at.context] * at.parent[at.word]).sum(1) + at.seen
            for origin, parts in mail[TOKEN_PAIRS]:
                word, context, times = layout.unpack(parts)
                size = int(times.sum())
                row = _from_planes(parts[4], size, f"<u{len(parts[4]) // size}").astype(np.int64)
                w, known = _places(at.words, word)
                c, met_context = _places(at.contexts, context)
                here = met_context & (known | ~layout.spread_out(word))
                w, c = np.where(known, w, 0), np.where(met_context, c, 0)
                chance = np.ones(len(word))
                some = here & known
                chance[some] = (at.back_off[c[some]] * at.parent[w[some]]).sum(1)
                some = here & ~known
                chance[some] = at.back_off[c[some]] @ unknown
                d, dished = at.dish(w, c)
                dished &= here & known
                chance[dished] = dish_chance[d[dished]]
                base = np.zeros(len(word))
                base[known] = at.n[w[known]]
                base = np.log10((base + 1) / whole)
                pair = np.repeat(np.arange(len(word)), times)
                local = here[pair]
                p, place = pair[local], origin + row[local]
                places, which = np.unique(place, return_inverse=True)
                sums = [np.bincount(which, v, len(places)) for v in (np.ones(len(p)), known[p], base[p], np.log10(chance)[p])]
                held.append((places, *sums))
                if not local.all():
                    p = pair[~local]
                    yield 0, UNMET, origin, [x.astype("<u8").tobytes() for x in (origin + row[~local], word[p], context[p])]

        for batch in _batches(messages()):
            yield from own
            own.clear()
            yield with_no_id(batch)
        yield from own

    pairs = docs.select("doc_id", "text").mapInArrow(lean(sent), f"{MESSAGE}, doc_id {kind}")
    found = _delivered(model.samples.units.unionByName(pairs, allowMissingColumns=True)).mapInArrow(lean(met), f"{MESSAGE}, doc_id {kind}")
    return _totalled(_Table(found, "scores", f"{MESSAGE}, doc_id {kind}"), model, whole, unknown)


def _to_range(first: int) -> int:
    """Where the sums of a range of rows meet, by its first row."""
    return first // ROWS * 0x9E3779B1 >> 7 & 0x7FFFFFFF


def _totalled(found: _Table, model: Model, whole: float, unknown: np.ndarray) -> DataFrame:
    """Scores by row: sums of the units, and of pairs whose context or word a unit has not seen."""
    size = len(unknown)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mail in _mail(batches):
            sums: dict[int, np.ndarray] = {}
            for first, (places, n, known, base, score) in mail[ROW_SUMS]:
                own = sums.setdefault(first, np.zeros((4, ROWS)))
                place = _from_planes(places, len(places) // 4, "<u4")
                own[:, place] += [
                    _unpacked(n, len(place)), _unpacked(known, len(place)),
                    np.frombuffer(base, np.float64), np.frombuffer(score, np.float64),
                ]
            for first, (n, known, base, score) in sums.items():
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + some), *map(pa.array, (n[some].astype(np.int64), known[some].astype(np.int64), base[some], score[some]))],
                    ["place", *NUMBERS],
                )

    def unmet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                columns = [np.frombuffer(_opened_up(p), np.int64) for p in parts]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["place", "word", "context"])

    def values(column: str, without) -> list:
        return [F.coalesce(F.get(column, F.lit(k)), F.lit(float(x))) for k, x in enumerate(without)]

    chance = sum(b * p for b, p in zip(values("back_off", [1 / size] * size), values("parent", unknown)))
    rest = (
        found.of(UNMET).mapInArrow(unmet, "place bigint, word bigint, context bigint")
        .join(model.samples.words, "word", "left").join(model.samples.contexts.drop("number"), "context", "left")
        .select(
            "place", F.lit(1).cast("bigint").alias("n_tokens"), F.col("n").isNotNull().cast("bigint").alias("n_known"),
            F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(whole)).alias("base"), F.log10(chance).alias("score"),
        )
    )
    met = _delivered(found.of(ROW_SUMS)).mapInArrow(added, "place bigint, n_tokens bigint, n_known bigint, base double, score double")
    sums = met.unionByName(rest).groupBy("place").agg(*[F.sum(c).alias(c) for c in NUMBERS])
    ids = found.rows.where(F.col("kind") == ROW).select(F.col("origin").alias("place"), "doc_id")
    return ids.join(sums, "place").select("doc_id", "n_tokens", "n_known", F.col("base").alias("base_score"), "score")
