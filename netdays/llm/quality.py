"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages with one label. Every passage is encoded from its
characters, character pairs and word statistics; gated attention (tanh and sigmoid
halves multiplied) weighs the encoded passages, and the weighted mean decides. Encoder,
attention and classifier are learned together from document labels by Adam, on a
bounded sample of labelled rows. Scoring goes through the whole text; attention is
summed part by part, so memory doesn't grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm import suffixes
from netdays.llm.common import CHUNK, texts, written

LETTERS, PAIRS, SHAPE = 130, 256, 6
FEATURES = LETTERS + PAIRS + SHAPE


@dataclass(frozen=True)
class Settings:
    """The model is fitted on ``sample_rows`` labelled rows at most, of texts of at most
    ``sample_passages`` passages; every passage of every text is scored."""

    passage: int = 1_000
    sample_rows: int = 6_000
    sample_passages: int = 40
    hidden: int = 24
    attention: int = 12
    epochs: int = 12
    batch: int = 64
    rate: float = 0.003
    decay: float = 1e-4
    seed: int = 13


def passages(text: str, settings: Settings) -> Iterator[np.ndarray]:
    """Features of a text's passages, a bounded number of rows at a time; an empty text is one passage."""
    step = max(1, CHUNK // settings.passage) * settings.passage
    for at in range(0, max(1, len(text)), step):
        part = text[at:at + step]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        count = max(1, -(-len(points) // settings.passage))
        where = np.arange(len(points)) // settings.passage
        # Characters: ASCII ones, other letters, all else.
        kinds = np.minimum(points, 128).astype(np.int64)
        kinds[(points >= 128) & ((points < 0xAA) | (points > 0x24F)) & (points < 0x370)] = 129
        letters = np.bincount(where * LETTERS + kinds, minlength=count * LETTERS).reshape(count, LETTERS)
        pairs = (kinds[:-1] * 31 + kinds[1:] * 7) * 2_654_435_761 >> 8 & (PAIRS - 1)
        pairs = np.bincount(where[:-1] * PAIRS + pairs, minlength=count * PAIRS).reshape(count, PAIRS)
        shape = np.zeros((count, SHAPE))
        sizes = np.maximum(np.bincount(where, minlength=count), 1)
        # Words by where they start; offsets are bytes, and characters where all is ASCII.
        octets = np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8)
        hashes, starts, ends = suffixes.word_hashes(octets)
        if len(hashes):
            characters = np.cumsum((octets & 0xC0) != 0x80) - 1
            of = characters[starts] // settings.passage
            words = np.maximum(np.bincount(of, minlength=count), 1)
            order = np.lexsort((hashes, of))
            h, o = hashes[order], of[order]
            first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])))
            runs = np.diff(np.append(first, len(h)))
            shape[:, 0] = np.bincount(o[first], minlength=count) / words
            np.maximum.at(shape[:, 1], o[first], runs / words[o[first]])
            shape[:, 2] = np.bincount(of, ends - starts, minlength=count) / words / 10
            again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]))
            shape[:, 3] = np.bincount(of[again], minlength=count) / words
            shape[:, 4] = np.log1p(np.bincount(of, minlength=count)) / 5
        shape[:, 5] = np.log1p(sizes) / 7
        yield np.concatenate([letters / sizes[:, None], np.sqrt(pairs / sizes[:, None]), shape], axis=1).astype(np.float32)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def encoded(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention before the softmax."""
        w = self.weights
        hidden = np.tanh((rows - self.mean) / self.scale @ w["encode"] + w["encode_0"])
        gate = np.tanh(hidden @ w["tanh"]) / (1 + np.exp(-(hidden @ w["gate"])))
        return hidden, gate @ w["attend"]

    def score(self, text: str, settings: Settings) -> float:
        most, total, summed = -np.inf, 0.0, 0.0
        for rows in passages(text, settings):
            hidden, attention = self.encoded(rows)
            top = max(most, float(attention.max()))
            e, kept = np.exp(attention - top), np.exp(most - top)
            summed, total, most = summed * kept + e @ hidden, total * kept + e.sum(), top
        logit = float(summed / total @ self.weights["decide"] + self.weights["decide_0"][0])
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """A model from bags of passage features and their labels."""
    random = np.random.default_rng(settings.seed)
    stacked = np.concatenate(bags)
    mean, scale = stacked.mean(axis=0), stacked.std(axis=0) + 1e-3
    m, k = settings.hidden, settings.attention
    shapes = {
        "encode": (FEATURES, m), "encode_0": (m,), "tanh": (m, k), "gate": (m, k), "attend": (k,),
        "decide": (m,), "decide_0": (1,),
    }
    w = {n: random.standard_normal(s) / np.sqrt(s[0]) * (0 if n.endswith("_0") else 1) for n, s in shapes.items()}
    moments = {n: (np.zeros(s), np.zeros(s)) for n, s in shapes.items()}
    turn = 0
    for _ in range(settings.epochs):
        order = random.permutation(len(bags))
        for at in range(0, len(order), settings.batch):
            chosen = order[at:at + settings.batch]
            sizes = np.array([len(bags[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            bag = np.repeat(np.arange(len(chosen)), sizes)
            x = (np.concatenate([bags[i] for i in chosen]) - mean) / scale
            h = np.tanh(x @ w["encode"] + w["encode_0"])
            t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
            s = (t * g) @ w["attend"]
            e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
            a = e / np.add.reduceat(e, starts)[bag]
            z = np.add.reduceat(a[:, None] * h, starts)
            p = 1 / (1 + np.exp(-(z @ w["decide"] + w["decide_0"][0])))
            # Back through the bag's decision, its attention and the encoder.
            dl = (p - labels[chosen]) / len(chosen)
            dz = dl[:, None] * w["decide"][None, :]
            da = (h * dz[bag]).sum(axis=1)
            ds = a * (da - np.add.reduceat(a * da, starts)[bag])
            dgate = ds[:, None] * w["attend"][None, :]
            dt, dg = dgate * g * (1 - t * t), dgate * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h * h)
            slopes = {
                "encode": x.T @ dh, "encode_0": dh.sum(axis=0), "tanh": h.T @ dt, "gate": h.T @ dg,
                "attend": (t * g).T @ ds, "decide": z.T @ dl, "decide_0": np.array([dl.sum()]),
            }
            turn += 1
            for n, slope in slopes.items():
                first, second = moments[n]
                slope = slope + settings.decay * w[n]
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                w[n] -= settings.rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return Model(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``; None without labels.

    Rows with a null id or label teach nothing; of an id with several labels the mean
    is rounded.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.round(F.avg("quality")).cast("double").alias("label")
    )
    known = written(known, "labels")
    count = known.count()
    if not count:
        return None
    rate = min(1.0, settings.sample_rows / count)
    chosen = known.where((F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) + 0.5) / 1_000_000 < rate)
    short = docs.where(F.length("text") <= settings.passage * settings.sample_passages)
    sample = short.join(chosen, "doc_id").select("doc_id", "text", "label").dropDuplicates(["doc_id"])

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [np.concatenate(list(passages(t, settings))).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())], ["doc_id", "label", "bag"]
            )

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["doc_id"], r["label"], r["bag"]) for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        rows.sort()  # however they arrive
        bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, _, b in rows]
        model = fit_bags(bags, np.array([y for _, y, _ in rows]), settings)
        parts = {"mean": model.mean, "scale": model.scale, **model.weights}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts)), pa.array([list(v.shape) for v in parts.values()], pa.list_(pa.int32())),
             pa.array([v.astype("<f8").tobytes() for v in parts.values()], pa.binary())],
            ["name", "shape", "values"],
        )

    kind = dict(sample.dtypes)["doc_id"]
    bags = written(sample.mapInArrow(featured, f"doc_id {kind}, label double, bag binary"), "bags")
    fitted = bags.repartition(1).mapInArrow(trained, "name string, shape array<int>, values binary").collect()
    parts = {r["name"]: np.frombuffer(r["values"], "<f8").reshape(r["shape"]) for r in fitted}
    return Model(parts.pop("mean"), parts.pop("scale"), parts) if parts else None


def scored(docs: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, score)``, one row per row of ``docs``: how likely label 1 is.

    Only the text counts; a null text is empty. Without a model every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [0.5 if shared.value is None else shared.value.score(t, settings) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
