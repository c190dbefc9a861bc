"""SentencePiece BPE by a table of each prefix's last token.

A sequence of pieces is the encoding of its text exactly if each piece encodes
to itself and each two neighbours stay apart when their joint text is encoded
alone: no merge ever crosses a boundary that survives, so what happens left and
right of it is independent. Hence each prefix of a text has one last token: the
piece that ends there (found by an automaton) and is compatible with the last
token of the prefix before it. The table is filled left to right and the ids are
read off backwards.

No piece holds the blank mark after another character, so no token crosses
the start of a blank run. Texts are cut there, and each distinct section is
encoded once while it stays in the bounded cache of a worker.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from netdays.llm.common import texts

# Fixed values of the model format.
BLANK = "▁"
NORMAL, CONTROL, BYTE = 1, 3, 6

# Sections of each of two generations, and pairs, that one worker remembers.
SECTIONS = 250_000
PAIRS = 400_000
# Marks of the prefix table: before the first character; a character that is no piece.
START, STRANGE = -2, 1 << 24
# Sections up to this many characters are remembered.
SHORT = 48


class PieceModel:
    """A BPE model with byte fallback, read from its file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as messages

        model = messages.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
                or not norm.escape_whitespaces or not trainer.byte_fallback
                or trainer.treat_whitespace_as_suffix or trainer.model_type != 2):
            raise ValueError("only a BPE model with byte fallback and identity normalisation is supported")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece crosses the start of a blank run")
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.octets = set(self.bytes.values())
        control = {p.piece: i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.begin, self.end = control["<s>"], control["</s>"]
        self.surface = [p.piece.replace(BLANK, " ").encode() if p.type == NORMAL else b"" for p in model.pieces]
        for octet, i in self.bytes.items():
            self.surface[i] = bytes([octet])
        self.surface[trainer.unk_id] = trainer.unk_surface.encode()
        self.automaton = ahocorasick.Automaton()
        self.edges: dict[str, tuple] = {}
        for piece in self.ids:
            if self.edges_of(piece) is not None:
                self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()
        self.names = {i: p for p, i in self.ids.items()}
        self.lengths = [len(p.piece) for p in model.pieces]
        self.single = {p for p in self.ids if len(p) == 1}
        self.pairs: dict[int, bool] = {}
        self.sections = Sections(self)

    def edges_of(self, piece: str) -> tuple | None:
        """How a piece arises: its merges' scores in their order, and with each its outer symbols.

        None if merging its characters doesn't give the piece.
        """
        if (known := self.edges.get(piece)) is not None:
            return known
        parts, scores, firsts, lasts = list(piece), [], [piece[0]], [piece[-1]]
        while len(parts) > 1:
            score, at = max(
                ((self.scores.get(parts[k] + parts[k + 1], -np.inf), -k) for k in range(len(parts) - 1))
            )
            if score == -np.inf:
                return None
            parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
            scores.append(score)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        self.edges[piece] = scores, firsts, lasts
        return self.edges[piece]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary while both tokens arise side by side.

        The best score goes first, then the leftmost pair: a merge within the left
        token, one across, one within the right token.
        """
        pair = left << 32 | right
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        left, right = (self.names[t] if t < STRANGE else chr(t - STRANGE) for t in (left, right))
        left_scores, _, lasts = self.edges_of(left)
        right_scores, firsts, _ = self.edges_of(right)
        i = j = 0
        while True:
            across = self.scores.get(lasts[i] + firsts[j], -np.inf)
            one = left_scores[i] if i < len(left_scores) else -np.inf
            other = right_scores[j] if j < len(right_scores) else -np.inf
            if one == other == across == -np.inf:
                known = True
                break
            if one >= across and one >= other:
                i += 1
            elif across >= other:
                known = False
                break
            else:
                j += 1
        self.pairs[pair] = known
        return known

    def tokens(self, text: str) -> list[int]:
        """The tokens of a text of any length, by the prefix table.

        A token is a piece's id, or STRANGE and more for a character that is no piece.
        """
        last = [-1] * (len(text) + 1)
        last[0] = START
        known, compatible = self.pairs.get, self.compatible
        plain = self.single.issuperset(text)
        for end, (token, length) in self.automaton.iter(text) if plain else self._ending(text):
            if last[end + 1] == -1 and (previous := last[end + 1 - length]) != -1:
                if previous == START:
                    last[end + 1] = token
                else:
                    fits = known(previous << 32 | token)
                    if fits or fits is None and compatible(previous, token):
                        last[end + 1] = token
        backwards, at, lengths = [], len(text), self.lengths
        while at:
            token = last[at]
            backwards.append(token)
            at -= lengths[token] if token < STRANGE else 1
        backwards.reverse()
        return backwards

    def _ending(self, text: str) -> Iterator[tuple[int, tuple[int, int]]]:
        """As the automaton's matches, and among them the characters that are no piece."""
        strange = [(at, (STRANGE + ord(c), 1)) for at, c in enumerate(text) if c not in self.single]
        return heapq.merge(self.automaton.iter(text), strange, key=lambda x: x[0])

    def packed(self, text: str) -> bytes:
        """The ids of one section as little-endian unsigned 32-bit integers."""
        ids = self.tokens(text)
        if max(ids) >= STRANGE:
            ids = [
                i for token in ids
                for i in ([token] if token < STRANGE else [self.bytes[b] for b in chr(token - STRANGE).encode()])
            ]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """All ids of a text, begin and end included, packed; an empty text has no others."""
        inner = b""
        if text and (text[0] == " " or "  " in text or BLANK in text):
            marked = BLANK + text.replace(" ", BLANK)
            inner = b"".join(map(self.packed, re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", marked)))
        elif text:  # every section starts at its one blank
            inner = b"".join(map(self.sections.__getitem__, text.split(" ")))
        ends = struct.pack("<2I", self.begin, self.end)
        return ends[:4] + inner + ends[4:]

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids in UTF-8: pieces joined, without the blank put first."""
        ids = np.frombuffer(packed, "<u4").tolist()
        out = b"".join(map(self.surface.__getitem__, ids))
        try:
            out.decode()
        except UnicodeDecodeError:  # ids that no text has
            out = b"".join(
                _replaced(b"".join(map(self.surface.__getitem__, run))) if in_bytes
                else b"".join(map(self.surface.__getitem__, run))
                for in_bytes, run in groupby(ids, key=self.octets.__contains__)
            )
        first = next((i for i in ids if self.surface[i]), None)
        return out[1:] if out[:1] == b" " and first not in self.octets else out


class Sections(dict):
    """Ids of the sections met so far, each stored without its blank.

    Of the two generations the older one goes when the younger is full, so memory
    is bounded and frequent sections stay.
    """

    def __init__(self, pieces: PieceModel):
        super().__init__()
        self.pieces = pieces
        self.older: dict[str, bytes] = {}

    def __missing__(self, section: str) -> bytes:
        ids = self.older.get(section)
        if ids is None:
            ids = self.pieces.packed(BLANK + section)
        if len(section) <= SHORT:
            if len(self) >= SECTIONS:
                self.older = dict(self)
                self.clear()
            self[section] = ids
        return ids


def _replaced(octets: bytes) -> bytes:
    """Valid UTF-8 stays; each other byte becomes the replacement character."""
    try:
        octets.decode()
        return octets
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(octets):
        for size in (1, 2, 3, 4):
            try:
                octets[at:at + size].decode()
            except UnicodeDecodeError:
                continue
            out.append(octets[at:at + size])
            at += size
            break
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)``: each row's ids packed as little-endian unsigned 32-bit integers.

    A null text is empty: begin and end id only. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            ids = [pieces.encode(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` from rows of ``(doc_id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            out = [pieces.decode(i or b"").decode() for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of an encoding and its decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            ids = [pieces.encode(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(pieces.decode(i)).hexdigest() for i in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
