"""Repeated passages by sparse suffix arrays.

Of all suffixes only those at minimiser positions are kept: in each window of
starts, the one whose first words hash lowest. A passage of ``min_words`` words
selects the same suffix wherever it stands, and that suffix shares its first
``prefix`` words with its copies. Suffixes whose prefix no other text has are left
behind. The others meet with the words around them, are sorted by their words, and
neighbours' common lengths say how far each agrees to the right. Matches are then
extended to the left: a passage is repeated where suffixes that agree to its right
end have the same words from its left end on. Repeated passages that touch join
into spans. Positions are exact; words are compared by 64-bit hashes.

A prefix that more than ``CROWD`` texts have, or that a text has more than ``OFTEN``
times, doesn't meet in one task: its passages are aggregated one by one, by a hash of
all their words, which gives the same spans.

Equal texts are one class, of which only the first is looked into; later copies
repeat as a whole. A passage that recurs only within one text is no repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import CHUNK, by_size, lean, texts, unit_starts, whole_units, written

# Texts with one prefix, and passages of a text that select it, which one task holds at most.
CROWD = 4_000
OFTEN = 128

# Size of the bitmap that tells which texts to look into again: 8 MB, whatever the corpus.
BITS = 1 << 26

PLACED = "doc_id bigint, text_class bigint, at bigint, last bigint, start bigint, end bigint, first_doc_id bigint"


@dataclass(frozen=True)
class Settings:
    """``window`` starts share one kept suffix; the prefix is what then lies inside any passage."""

    min_words: int = 50
    window: int = 32

    @property
    def prefix(self) -> int:
        return self.min_words - self.window + 1


_random = np.random.default_rng(20_011)
_BYTES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = int(_random.integers(1 << 62, 1 << 63)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64, as many as are asked for or more."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each range of values that doesn't depend on where the range lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values))[: len(values)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _power(_INVERSE, len(values) + 1)[starts])


def word_hashes(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of some bytes."""
    inside = np.concatenate(([False], ~_SPACE[octets], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return _ranges(_BYTES[octets], starts, ends), starts, ends


@dataclass
class Words:
    """A text's words: hashes, and the characters where each starts and ends."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, text: str) -> Words:
        parts, at = [], 0
        while at < len(text):
            end = at + CHUNK
            while end < len(text) and not _SPACE[min(ord(text[end]), 255)]:
                end += 1  # whole words only
            parts.append(cls._chunk(text[at:end], at))
            at = end
        if not parts:
            none = np.zeros(0, np.int64)
            return cls(none.astype(np.uint64), none, none)
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("hashes", "starts", "ends")))

    @classmethod
    def _chunk(cls, text: str, before: int) -> Words:
        octets = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        hashes, starts, ends = word_hashes(octets)
        if len(octets) == len(text):
            first, last = starts, ends
        else:
            characters = np.concatenate(([0], np.cumsum((octets & 0xC0) != 0x80)))
            first, last = characters[starts], characters[ends]
        return cls(hashes, first + before, last + before)

    def runs(self, length: int) -> np.ndarray:
        """A hash for each run of ``length`` words."""
        at = np.arange(max(0, len(self.hashes) - length + 1))
        return _ranges(self.hashes, at, at + length)


def _kept(prefixes: np.ndarray, window: int) -> np.ndarray:
    """For each passage, the position of its kept suffix: the leftmost lowest of its window."""
    kept = np.empty(len(prefixes) - window + 1, np.int64)
    for at in range(0, len(kept), 1 << 17):
        part = np.lib.stride_tricks.sliding_window_view(prefixes[at:at + (1 << 17) + window - 1], window)
        kept[at:at + len(part)] = part.argmin(axis=1) + np.arange(at, at + len(part))
    return kept


def _measured(docs: DataFrame, settings: Settings) -> DataFrame:
    """Each row's text class, size and kept suffixes: their distinct prefixes, and which are there often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, start, end, kept, often = [], [], [], [], []
            for text in texts(batch):
                words = Words.of(text)
                size.append(len(words.hashes))
                start.append(int(words.starts[0]) if size[-1] else 0)
                end.append(int(words.ends[-1]) if size[-1] else 0)
                found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if size[-1] >= settings.min_words:
                    prefixes = words.runs(settings.prefix)
                    found, counts = np.unique(prefixes[_kept(prefixes, settings.window)], return_counts=True)
                kept.append(found.view(np.int64))
                often.append(counts > OFTEN)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_class"), pa.array(size, pa.int64()),
                    pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(kept, pa.list_(pa.int64())),
                    pa.array(often, pa.list_(pa.bool_())),
                ],
                ["doc_id", "text_class", "n_words", "start", "end", "prefixes", "often"],
            )

    schema = (
        "doc_id bigint, text_class bigint, n_words bigint, start bigint, end bigint, "
        "prefixes array<bigint>, often array<boolean>"
    )
    return docs.select("doc_id", "text_class", "text").mapInArrow(lean(run), schema)


def _likely(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose keys ``wanted`` lacks, so that fewer go into a join.

    Keys are looked up in a bitmap of ``BITS`` bits; where it is crowded more rows stay, but none is lost.
    """

    def marked(frame: DataFrame) -> DataFrame:
        bit = F.pmod(F.xxhash64(*keys), F.lit(BITS))
        return frame.withColumns({"bucket": F.bitmap_bucket_number(bit), "bit": F.bitmap_bit_position(bit)})

    bitmaps = marked(wanted.select(*keys)).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    octet = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("1 << int(bit % 8)").bitwiseAND(octet) > 0
    return marked(rows).join(F.broadcast(bitmaps), "bucket").where(is_set).select(*rows.columns)


def _pieces(docs: DataFrame, settings: Settings) -> DataFrame:
    """What stands around matched suffixes, from texts with their ``prefixes`` and ``crowded`` ones.

    Neighbouring passages that select the same prefix are one piece ``(prefix, at, start,
    text)``: the text from the first one's first word to the last one's last. Those of
    crowded prefixes are rows of their own, ``(passage, at, start, end)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["prefix", "passage", "doc_id", "text_class", "at", "start", "end", "text"]
        for batch in batches:
            for row, text in enumerate(texts(batch)):
                words = Words.of(text)
                prefixes = words.runs(settings.prefix)
                own = prefixes[_kept(prefixes, settings.window)].view(np.int64)
                crowd = np.isin(own, batch.column("crowded")[row].values.to_numpy())
                wanted = np.isin(own, batch.column("prefixes")[row].values.to_numpy())
                new = np.flatnonzero(wanted & ~crowd & np.append(True, (own[1:] != own[:-1])))
                edges = np.append(np.flatnonzero(own[1:] != own[:-1]) + 1, len(own))
                last = edges[np.searchsorted(edges, new, "right")] - 1
                single = np.flatnonzero(crowd)
                passages = words.runs(settings.min_words).view(np.int64)[single]
                ids = [batch.column(n)[row].as_py() for n in ("doc_id", "text_class")]

                def rows(at, until, prefix, passage, piece) -> pa.RecordBatch:
                    columns = (
                        prefix, passage, *(np.full(len(at), i) for i in ids), at, words.starts[at],
                        words.ends[until + settings.min_words - 1],
                    )
                    kinds = [pa.array(c, pa.int64()) for c in columns]
                    return pa.RecordBatch.from_arrays([*kinds, pa.array(piece, pa.string())], names)

                for part in range(0, len(new), 10_000):
                    p, q = new[part:part + 10_000], last[part:part + 10_000]
                    ends = words.ends[q + settings.min_words - 1]
                    yield rows(p, q, own[p], [None] * len(p), [text[x:y] for x, y in zip(words.starts[p], ends)])
                for part in range(0, len(single), 100_000):
                    p = single[part:part + 100_000]
                    none = [None] * len(p)
                    yield rows(p, p, none, passages[part:part + 100_000], none)

    schema = (
        "prefix bigint, passage bigint, doc_id bigint, text_class bigint, at bigint, start bigint, end bigint, text string"
    )
    return docs.select("doc_id", "text_class", "text", "prefixes", "crowded").mapInArrow(lean(run), schema)


def _words_of(pieces: list[str]) -> tuple[Words, np.ndarray]:
    """All words of some pieces, with characters counted from each piece's start, and each piece's first word."""
    parts, counts = [], []
    for low, high in by_size(pieces, len):
        if high - low == 1:
            parts.append(Words.of(pieces[low]))
            counts.append([len(parts[-1].hashes)])
            continue
        joined = Words._chunk("\n".join(pieces[low:high]), 0)
        offsets = np.cumsum([0] + [len(p) + 1 for p in pieces[low:high - 1]])
        piece = np.searchsorted(offsets, joined.starts, "right") - 1
        parts.append(Words(joined.hashes, joined.starts - offsets[piece], joined.ends - offsets[piece]))
        counts.append(np.bincount(piece, minlength=high - low))
    words = Words(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("hashes", "starts", "ends")))
    return words, np.append(0, np.cumsum(np.concatenate(counts)))


def common_lengths(suffixes: np.ndarray) -> np.ndarray:
    """How many leading columns each of some sorted rows has in common with the row before it."""
    same = suffixes[1:] == suffixes[:-1]
    return np.append(0, np.where(same.all(axis=1), suffixes.shape[1], same.argmin(axis=1)))


def _extended(pieces: DataFrame, settings: Settings) -> DataFrame:
    """Runs of passages that several texts have, from pieces: a suffix array of each task's prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_class", "at", "last", "start", "end", "first_doc_id"]
        for table in whole_units(batches, ("prefix",), 20_000):
            c = {n: table.column(n).to_numpy() for n in ("prefix", "doc_id", "text_class", "at", "start")}
            words, offsets = _words_of(table.column("text").to_pylist())
            hashes, place = words.hashes, np.arange(len(words.hashes))
            row = np.repeat(np.arange(table.num_rows), np.diff(offsets))
            stop = offsets[row + 1]
            prefixes = _ranges(hashes, place, np.minimum(place + settings.prefix, stop)).view(np.int64)
            anchors = np.flatnonzero((prefixes == c["prefix"][row]) & (place + settings.prefix <= stop))

            # The suffixes in their order: by prefix, then word by word as far as a passage can reach.
            more = anchors[:, None] + np.arange(settings.prefix, settings.min_words)
            array = np.zeros((len(anchors), settings.window), np.uint64)
            array[:, 0] = c["prefix"][row[anchors]].view(np.uint64)
            array[:, 1:] = np.where(more < stop[anchors][:, None], hashes[np.minimum(more, len(hashes) - 1)], 0)
            order = np.lexsort(array.T[::-1])
            common = common_lengths(array[order])
            # For each length to the right, suffixes in one run have that many words in common.
            runs = np.empty((settings.window, len(anchors)), np.int64)
            for length in range(settings.window):
                runs[length, order] = np.cumsum(common < length + 1)

            # Each passage stands around the first of its suffixes: common words to the right, then to the left.
            passage = np.flatnonzero(place + settings.min_words <= stop)
            anchor = np.searchsorted(anchors, passage)
            left = anchors[anchor] - passage
            agrees = runs[settings.window - 1 - left, anchor] * settings.window + left
            before = _ranges(hashes, passage, anchors[anchor])
            order = np.lexsort((before, agrees))
            changed = (agrees[order][1:] != agrees[order][:-1]) | (before[order][1:] != before[order][:-1])
            first = np.flatnonzero(np.append(True, changed))
            text = c["text_class"][row[passage[order]]]
            several = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
            sizes = np.diff(np.append(first, len(order)))
            shared, owner = np.empty(len(order), bool), np.empty(len(order), np.int64)
            shared[order] = np.repeat(several, sizes)
            owner[order] = np.repeat(np.minimum.reduceat(c["doc_id"][row[passage[order]]], first), sizes)

            passage, owner = passage[shared], owner[shared]
            if not len(passage):
                continue
            new = np.append(
                True, (row[passage][1:] != row[passage][:-1]) | (passage[1:] != passage[:-1] + 1) | (owner[1:] != owner[:-1])
            )
            first = np.flatnonzero(new)
            begin, final = passage[first], passage[np.append(first[1:], len(passage)) - 1]
            r = row[begin]
            columns = [
                c["doc_id"][r], c["text_class"][r], c["at"][r] + begin - offsets[r], c["at"][r] + final - offsets[r],
                c["start"][r] + words.starts[begin], c["start"][r] + words.ends[final + settings.min_words - 1], owner[first],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    return (
        pieces.select("prefix", "doc_id", "text_class", "at", "start", "text")
        .repartition("prefix").sortWithinPartitions("prefix").mapInArrow(lean(run), PLACED)
    )


def repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, text_class, start, end, n_words, first_doc_id, kept)``: repeated spans of documents.

    A span is a run of passages of at least ``min_words`` words that stand in
    another text too, from character ``start`` to ``end``. ``kept`` spans stand here
    first, by the smallest id; the others repeat one of document ``first_doc_id``.
    A document has no row if nothing in it repeats; texts that are null or shorter
    have none, an empty table has no row. Texts of any length are read whole. Rows with a
    null id come last in that order and keep a null id; rows that repeat with id and text
    count as one text. Other columns are not read.
    """
    last = F.lit(2**63 - 1)
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), last).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_class", F.xxhash64("text"))
    measured = written(_measured(named, settings), "measured")
    long = measured.where(F.col("n_words") >= settings.min_words)
    firsts = written(
        long.groupBy("text_class").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("copies")), "firsts"
    )
    placed = long.join(firsts, "text_class")
    suffixes = written(
        placed.where("doc_id = first_doc_id").select(
            F.explode(F.arrays_zip("prefixes", "often")).alias("s"), "text_class", "doc_id"
        ).select("s.*", "text_class", "doc_id").withColumnsRenamed({"prefixes": "prefix"}),
        "suffixes",
    )
    matched = (
        suffixes.groupBy("prefix").agg(
            F.min("text_class").alias("low"), F.max("text_class").alias("high"),
            (F.bool_or("often") | (F.count(F.lit(1)) > CROWD)).alias("crowd"),
        ).where("low < high").select("prefix", "crowd")
    )
    candidates = written(
        suffixes.select("prefix", "text_class", "doc_id").join(matched, "prefix").groupBy("doc_id", "text_class").agg(
            F.collect_set("prefix").alias("prefixes"),
            F.collect_set(F.when(F.col("crowd"), F.col("prefix"))).alias("crowded"),
        ),
        "candidates",
    )
    key = ["doc_id", "text_class"]
    pieces = written(_pieces(_likely(named, candidates, key).join(candidates, key), settings), "pieces")
    single = pieces.where("passage is not null")
    shared = written(
        single.groupBy("passage").agg(
            F.min("doc_id").alias("first_doc_id"), F.min("text_class").alias("low"), F.max("text_class").alias("high")
        ).where("low < high").select("passage", "first_doc_id"),
        "shared",
    )
    crowded = single.join(shared, "passage").select(
        "doc_id", "text_class", "at", F.col("at").alias("last"), "start", "end", "first_doc_id"
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans from a document's runs of passages in their order; kept and other ones apart."""
        names = ["doc_id", "text_class", "start", "end", "n_words", "first_doc_id", "kept"]
        for table in whole_units(batches, ("doc_id", "text_class", "kept"), 20_000):
            c = {n: table.column(n).to_numpy(zero_copy_only=False) for n in table.column_names}
            new = np.ones(table.num_rows, bool)
            same = (c["doc_id"][1:] == c["doc_id"][:-1]) & (c["text_class"][1:] == c["text_class"][:-1])
            same &= c["kept"][1:] == c["kept"][:-1]
            # Passages that overlap or touch are one span.
            new[1:] = ~(same & (c["at"][1:] <= c["last"][:-1] + settings.min_words))
            first = np.flatnonzero(new)
            final = np.append(first[1:], table.num_rows) - 1
            columns = [
                c["doc_id"][first], c["text_class"][first], c["start"][first], c["end"][final],
                c["last"][final] - c["at"][first] + settings.min_words,
                np.minimum.reduceat(c["first_doc_id"], first), c["kept"][first],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    schema = "doc_id bigint, text_class bigint, start bigint, end bigint, n_words bigint, first_doc_id bigint, kept boolean"
    order = ("doc_id", "text_class", "kept")
    inner = (
        _extended(pieces.where("passage is null"), settings).unionByName(crowded)
        .withColumn("kept", F.col("doc_id") == F.col("first_doc_id"))
        .repartition("doc_id", "text_class").sortWithinPartitions(*order, "at")
        .select(*order, "at", "last", "start", "end", "first_doc_id").mapInArrow(lean(joined), schema)
    )
    whole = placed.where("copies > 1").select(
        "doc_id", "text_class", "start", "end", "n_words", "first_doc_id", (F.col("doc_id") == F.col("first_doc_id")).alias("kept")
    )
    return inner.unionByName(whole).withColumn("doc_id", F.nullif("doc_id", last)).withColumn(
        "first_doc_id", F.nullif("first_doc_id", last)
    )


def without_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every repeated span cut out of ``text`` except where it stands first.

    All rows and columns stay; a text that is repeated as a whole becomes what is
    left around its words, and a null text stays null.
    """
    key = ["__id", "__class"]
    spans = written(
        repeats(docs, settings).where("not kept").groupBy("doc_id", "text_class")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
        .select(F.col("doc_id").alias("__id"), F.col("text_class").alias("__class"), "__spans"),
        "spans",
    )
    rows = docs.withColumn("__id", F.col("doc_id").cast("bigint")).withColumn("__class", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = rows.join(
        spans, rows["__id"].eqNullSafe(spans["__id"]) & (rows["__class"] == spans["__class"]), "left"
    ).drop(*key)
    # What stands before each span, then what follows the last one; spans of one text may overlap.
    cut = F.expr(
        "aggregate(__spans, named_struct('at', 0L, 'text', ''), (a, s) -> named_struct("
        "'at', greatest(a.at, s.end), "
        "'text', concat(a.text, substring(text, int(a.at + 1), int(greatest(s.start - a.at, 0L))))), "
        "a -> concat(a.text, substring(text, int(a.at + 1))))"
    )
    return found.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
