"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed 1- to 3-grams of the lower-cased letters (every run of other
characters is one blank), weighted by TF-IDF and scaled to length one. Document
frequencies count every training row; the weights are fitted on a bounded sample
by follow-the-regularised-leader with elastic-net penalties, and the class
scores are then divided by a temperature fitted on rows the weights never saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netdays.llm.common import CHUNK, lean, texts, written

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the rows the weights are fitted on, split evenly over the
    languages; document frequencies always count every training row."""

    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 15
    sample_rows: int = 6_000
    calibration: float = 0.2
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    seed: int = 11


# Whether a code point is a letter.
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _hashes(points: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """A bucket for each n-gram of code points."""
    mixed = np.full(max(0, len(points) - order + 1), order, np.uint32)
    for k in range(order):
        mixed = (mixed ^ points[k:k + len(mixed)]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return mixed & np.uint32(buckets - 1)


def grams(text: str, settings: Settings) -> np.ndarray | None:
    """How often each bucket occurs; None if the text has no letter. Memory is bounded."""
    counts = np.zeros(settings.buckets, np.int64)
    context, lettered = np.array([32], np.uint32), False
    for at in range(0, len(text), CHUNK):
        part = text[at:at + CHUNK].lower()
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(_letter_table()[points], points, np.uint32(32))
        fresh = points[(points != 32) | (np.concatenate((context[-1:], points[:-1])) != 32)]
        lettered = lettered or bool((fresh != 32).any())
        for order in settings.orders:  # those that end in this part
            before = context[max(0, len(context) - order + 1):]
            counts += np.bincount(
                _hashes(np.concatenate((before, fresh)), order, settings.buckets), minlength=settings.buckets
            )
        context = np.concatenate((context, fresh))[-max(settings.orders):]
    return counts if lettered else None


def document_frequencies(rows: DataFrame, settings: Settings) -> DataFrame:
    """``(bucket, documents)`` over all rows; bucket -1 counts the rows that have a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(settings.buckets, np.int64), 0
        for batch in batches:
            for text in texts(batch):
                counts = grams(text, settings)
                if counts is not None:
                    seen += counts > 0
                    total += 1
        bucket = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bucket, -1)), pa.array(np.append(seen[bucket], total))], ["bucket", "documents"]
        )

    counted = rows.select("text").mapInArrow(lean(run), "bucket bigint, documents bigint")
    return counted.groupBy("bucket").agg(F.sum("documents").alias("documents"))


def _weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Settings) -> np.ndarray:
    """Follow-the-regularised-leader, per coordinate, with l1 and l2 penalties."""
    size = settings.buckets + 1  # the last one is the intercept
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def leader(at: np.ndarray) -> np.ndarray:
        zi, ni = z[at], n[at]
        shrunk = np.sign(zi) * settings.l1 - zi
        w = shrunk / ((settings.beta + np.sqrt(ni)) / settings.alpha + settings.l2)
        return np.where(np.abs(zi) <= settings.l1, 0.0, w)

    order = np.random.default_rng(settings.seed)
    for _ in range(settings.epochs):
        for k in order.permutation(len(rows)):
            at, values, label = rows[k]
            at, values = np.append(at, size - 1), np.append(values, 1.0)
            w = leader(at)
            slope = _softmax(values @ w)
            slope[label] -= 1
            g = values[:, None] * slope[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return leader(np.arange(size))


def _row(packed: tuple[bytes, bytes, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """A row's buckets and values as they lie in its bytes, nothing copied, and its label."""
    at, values, label = packed
    return np.frombuffer(at, "<u4"), np.frombuffer(values, "<f4"), label


def _ordered(rows: list[tuple[bytes, bytes, int]]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """The rows in one order however they arrive: by buckets, and where those are equal by values and label."""
    rows.sort(key=lambda r: r[0])
    same = (sorted(run, key=lambda r: (_row(r)[1].astype(float).tobytes(), r[2])) for _, run in groupby(rows, key=lambda r: r[0]))
    return [_row(r) for run in same for r in run]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings

    def scores(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return (values @ self.weights[at] + self.weights[-1]) / self.temperature

    def predict(self, text: str) -> tuple[str, float]:
        counts = grams(text, self.settings) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        chances = _softmax(self.scores(*_weighted(counts, self.idf)))
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def _uniform(salt: str, *columns: str) -> Column:
    """A number from 0 to 1 that depends on the given columns only."""
    return (F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(1_000_000)) + 0.5) / 1_000_000


def fit(training: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows of ``(doc_id, text, lang)``; rows without lang or letters teach nothing.

    The id only decides whether a row is in the sample.
    """
    rows = training.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").count().collect()  # one row per language
    languages = sorted(r["lang"] for r in counts)
    frequency = np.zeros(settings.buckets)
    total = 0
    for row in document_frequencies(rows, settings).collect():  # one row per bucket
        if row["bucket"] < 0:
            total = row["documents"]
        else:
            frequency[row["bucket"]] = row["documents"]
    idf = np.log((1 + total) / (1 + frequency)) + 1
    if not languages:
        return Model([], idf, np.zeros((settings.buckets + 1, 0)), 1.0, settings)
    share = settings.sample_rows / len(languages)
    rate = F.lit(0.0)
    for row in counts:
        rate = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, share / row["count"]))).otherwise(rate)
    sample = rows.where(_uniform("sample", "doc_id", "text") < rate).select(
        "text", "lang", (_uniform("calibration", "text") < settings.calibration).alias("held")
    )
    index = {name: k for k, name in enumerate(languages)}
    buckets = settings.buckets

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang, held in zip(texts(batch), batch.column("lang").to_pylist(), batch.column("held").to_pylist()):
                counts = grams(text, settings)
                if counts is not None:
                    at, values = _weighted(counts, idf)
                    out.append((at.astype("<u4").tobytes(), values.astype("<f4").tobytes(), index[lang], held))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.binary(), pa.binary(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["at", "values", "label", "held"]
            )

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, held = [], []
        for batch in batches:
            for r in batch.to_pylist():
                (held if r["held"] else train).append((r["at"], r["values"], r["label"]))
        weights = fit_weights(_ordered(train), len(languages), settings)
        scores = np.array([v.astype(float) @ weights[a] + weights[-1] for a, v, _ in map(_row, held)]).reshape(len(held), len(languages))
        temperature = fit_temperature(scores, np.array([y for _, _, y in held], int))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f8").tobytes()], pa.binary()), pa.array([temperature])],
            ["weights", "temperature"],
        )

    features = written(sample.mapInArrow(lean(featured), "at binary, values binary, label int, held boolean"), "language-sample")
    fitted = features.repartition(1).mapInArrow(lean(trained), "weights binary, temperature double").first()
    weights = np.frombuffer(fitted["weights"], "<f8").reshape(buckets + 1, len(languages))
    return Model(languages, idf, weights, fitted["temperature"], settings)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per row of ``docs``; only the text decides.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    where the training rows held no language. The model has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        lean(run), f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double"
    )


def lettered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter: those that any model with a language identifies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t)) for t in texts(batch)], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def identified(docs: DataFrame, model: Model, lang_column: str, score_column: str) -> DataFrame:
    """``docs`` with the predicted language and its score as two further columns.

    All rows and columns stay; the new names must differ from the given ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if {lang_column, score_column} & set(docs.columns):
        raise ValueError("a column has the name of a new one")
    names = [*docs.columns, lang_column, score_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in texts(batch)]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    fields = [*docs.schema.fields, T.StructField(lang_column, T.StringType()), T.StructField(score_column, T.DoubleType())]
    return docs.mapInArrow(lean(run), T.StructType(fields))
