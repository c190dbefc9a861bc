"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation of the principal axes is learned that makes the sign bits of the
sample's vectors lose as little as possible. Two vectors at the threshold differ
in a number of bits whose upper quantile is measured with the learned codes; that
is the Hamming radius. The code is cut into so many substrings that two codes
within the radius differ in at most one bit of one of them, and a table for each
bit of a substring, keyed by the substring without that bit, brings them together.
Each pair has one table where it is looked at; there its original vectors are
compared. Equal vectors are one class, pairs are counted where they meet and
never written, and a bucket of many codes is dealt out as pairs of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netdays.llm import vectors
from netdays.llm.common import local_components, matrix, unit_starts, whole_units, written
from netdays.llm.components import components


@dataclass(frozen=True)
class Settings:
    """The rotation is learned on ``sample_rows`` vectors at most; every vector is indexed.

    ``missed`` is the share of pairs at the threshold that the radius may miss;
    pairs above it are closer and are missed more rarely.
    """

    threshold: float = 0.95
    bits: int = 64
    sample_rows: int = 16_384
    iterations: int = 50
    missed: float = 0.001
    chunk: int = 4_096
    seed: int = 7


@dataclass(frozen=True)
class Codes:
    mean: np.ndarray
    axes: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The codes of vectors as unsigned integers."""
        scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        ones = (scaled - self.mean) @ self.axes > 0
        return (ones.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def substrings(self) -> list[list[int]]:
        """The bits of each substring; within the radius, one differs in one bit at most."""
        count = min(self.bits, self.radius // 2 + 1)
        return [list(map(int, part)) for part in np.array_split(np.arange(self.bits), count)]


def learn(sample: np.ndarray, settings: Settings = Settings()) -> Codes:
    """Axes for binary codes of vectors like the sample's."""
    unit = sample / np.abs(sample).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    centred = unit - mean
    bits = min(settings.bits, sample.shape[1], 64)
    _, vectors_ = np.linalg.eigh(centred.T @ centred)
    axes = vectors_[:, ::-1][:, :bits]
    projected = centred @ axes
    random = np.random.default_rng(settings.seed)
    rotation, _ = np.linalg.qr(random.standard_normal((bits, bits)))
    for _ in range(settings.iterations):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(projected.T @ signs)
        rotation = left @ right
    codes = Codes(mean, axes @ rotation, 0)
    # Partners at the threshold exactly, in random directions of the space and in those the
    # sample itself spreads in, where codes of fewer bits than dimensions differ more.
    radius = 0
    for noise in (random.standard_normal(unit.shape), unit - unit[random.permutation(len(unit))]):
        noise -= (noise * unit).sum(axis=1, keepdims=True) * unit
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
        partner = settings.threshold * unit + np.sqrt(1 - settings.threshold**2) * noise
        apart = np.bitwise_count(codes.of(unit) ^ codes.of(partner))
        if len(apart):
            radius = max(radius, int(np.quantile(apart, 1 - settings.missed, method="higher")))
    return Codes(mean, codes.axes, min(radius + 1, bits))


KEYS = ("block", "bit", "key", "one", "other")


def _dealt(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets ``(block, bit, key)``, crowded ones as all pairs of their chunks."""
    bucket = ["block", "bit", "key"]
    crowded = written(
        rows.groupBy(*bucket).count().where(F.col("count") > limit)
        .select(*bucket, F.ceil(F.col("count") / limit).cast("int").alias("chunks")),
        "crowded",
    )
    own = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    return (
        rows.join(crowded, bucket, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("one", F.least("own", "met")).withColumn("other", F.greatest("own", "met"))
        .withColumn("side", (F.col("own") > F.col("met")).cast("int"))
        .drop("chunks", "own", "met")
    )


def _near(codes: np.ndarray, side: np.ndarray, split: bool, block: int, bit: int, model: Codes) -> Iterator[tuple]:
    """Index pairs of one unit that are within the radius and have their place here."""
    parts = model.substrings()
    masks = [np.uint64(sum(1 << b for b in part)) for part in parts]
    here = masks[block]
    first = parts[block][0] == bit
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if split else left
    step = max(1, 2_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at:at + step]
        differing = codes[rows][:, None] ^ codes[right][None, :]
        near = np.bitwise_count(differing) <= model.radius
        if not split:
            near &= rows[:, None] < right[None, :]
        a, b = np.nonzero(near)
        if not len(a):
            continue
        x = differing[a, b]
        place = np.ones(len(x), bool) if first else (x & here) != 0
        for mask in masks[:block]:
            place &= np.bitwise_count(x & mask) >= 2
        if place.any():
            yield rows[a[place]], right[b[place]]


def _units(table: pa.Table, model: Codes) -> Iterator[tuple]:
    """Each unit's row range and its index pairs."""
    codes = table.column("code").to_numpy().view(np.uint64)
    side = table.column("side").to_numpy()
    starts = unit_starts(table, KEYS)
    columns = {k: table.column(k).to_numpy() for k in ("block", "bit", "one", "other")}
    for start, end in zip(starts, np.append(starts[1:], table.num_rows)):
        split = columns["one"][start] != columns["other"][start]
        for a, b in _near(
            codes[start:end], side[start:end], split, int(columns["block"][start]), int(columns["bit"][start]), model
        ):
            yield start + a, start + b


def near_components(rows: DataFrame, settings: Settings = Settings(),
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``rows``.

    ``n_links`` counts the other rows whose cosine is at least the threshold;
    ``component_id`` is the smallest id reachable over links, the row's own
    included. Rows that take no part (see ``vectors.comparable``) link with nothing;
    a null id has a null component and isn't kept. Other columns are not read.
    """
    valid = written(vectors.comparable(rows, id_column, vector_column), "comparable")
    distinct = vectors.classes(valid)
    everything = rows.select(F.col(id_column).cast("bigint").alias("vec_id"))
    drawn = vectors.sample(distinct, settings.sample_rows)
    if len(drawn) < 2:
        links = distinct.select("vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("component"))
    else:
        links = _class_links(distinct, learn(drawn, settings), settings)
    resolved = written(
        distinct.join(links, "vec_id", "left").select(
            "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        ),
        "resolved",
    )
    taking = valid.join(resolved, "vector").select("vec_id", "n_links", "component_id")
    # Rows that take no part: those beyond the ids' counts among the valid ones.
    rest = (
        everything.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"))
        .join(valid.groupBy("vec_id").agg(F.count(F.lit(1)).alias("m")), "vec_id", "left")
        .where("n > coalesce(m, 0)")
        .select("vec_id", F.explode(F.sequence(F.lit(1), (F.col("n") - F.coalesce("m", F.lit(0))).cast("int"))))
        .select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    )
    return taking.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def _class_links(distinct: DataFrame, model: Codes, settings: Settings) -> DataFrame:
    """``(vec_id, links, component)`` of the classes that have a link."""
    threshold, parts = settings.threshold, model.substrings()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = model.of(matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(codes.view(np.int64))], ["vec_id", "code"])

    codes = written(distinct.select("vec_id", "vector").mapInArrow(coded, "vec_id bigint, code bigint"), "codes")

    def signed(value: int) -> int:
        return value - (1 << 64) if value >> 63 else value

    tables = F.array(*[
        F.struct(
            F.lit(block).alias("block"), F.lit(bit).alias("bit"),
            F.col("code").bitwiseAND(F.lit(signed(sum(1 << b for b in part if b != bit))).cast("bigint")).alias("key"),
        )
        for block, part in enumerate(parts) for bit in part
    ])
    keyed = codes.select("vec_id", "code", F.explode(tables).alias("at")).select("vec_id", "code", "at.*")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches, KEYS, 50_000):
            seen = np.zeros(table.num_rows, bool)
            for a, b in _units(table, model):
                seen[a] = seen[b] = True
            kept = table.select([*KEYS, "side", "vec_id", "code"]).filter(pa.array(seen))
            yield from kept.to_batches()

    schema = "block int, bit int, key bigint, one int, other int, side int, vec_id bigint, code bigint"
    met = (
        _dealt(keyed, settings.chunk).select(*KEYS, "side", "vec_id", "code")
        .repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(meeting, schema)
    )
    # The few rows that meet a candidate come together again, now with their vectors.
    carried = written(met, "met").join(distinct, "vec_id")

    def reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches, KEYS, 20_000):
            rows = matrix(table.column("vector"))
            rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # else squares of huge components overflow
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            copies, ids = table.column("copies").to_numpy(), table.column("vec_id").to_numpy()
            links = np.zeros(len(ids), np.int64)
            left, right = [], []
            for a, b in _units(table, model):
                for at in range(0, len(a), 100_000):
                    i, j = a[at:at + 100_000], b[at:at + 100_000]
                    linked = np.einsum("ij,ij->i", rows[i], rows[j]) >= threshold
                    i, j = i[linked], j[linked]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    # Only links that connect something new are kept.
                    left.append(i)
                    right.append(j)
                if sum(map(len, left)) > 500_000:
                    root = local_components(len(ids), np.concatenate(left), np.concatenate(right))
                    member = np.flatnonzero(root != np.arange(len(ids)))
                    left, right = [member], [root[member]]
            if not left:
                continue
            root = local_components(len(ids), np.concatenate(left), np.concatenate(right))
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[root[linked]])], ["vec_id", "links", "root"]
            )

    found = written(
        carried.repartition(*KEYS).sortWithinPartitions(*KEYS).select(*KEYS, "side", "vec_id", "code", "copies", "vector")
        .mapInArrow(reranked, "vec_id bigint, links bigint, root bigint"),
        "near",
    )
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    return counted.join(reached, counted["vec_id"] == reached["node"], "left").select(
        counted["vec_id"], "links", F.coalesce("component", counted["vec_id"]).alias("component")
    )
