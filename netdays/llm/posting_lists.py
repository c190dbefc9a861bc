"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

One more component makes all vectors equally long (sqrt(M² - |x|²), M the longest
length), so that the largest inner product is the smallest distance. A sample is
halved again and again at the median between two centres, which gives lists of
equal size; the means of the parts are the centroids. A graph over the centroids,
held in memory, is searched for those near a vector. Every vector goes to its
nearest list and, near a boundary, to others as well: the nearest of those whose
centroid is at most a ratio further away. A query searches
all lists whose centroid is within a ratio of its nearest one; that ratio is
measured on the sample, as the one at which enough true neighbours are found.

Equal vectors are one class with its smallest ids, as no more of them can be in a
result. Long lists are dealt out in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from netdays.llm import vectors
from netdays.llm.common import matrix, unit_starts, whole_units, written


@dataclass(frozen=True)
class Settings:
    """The index is fitted on ``sample_rows`` vectors at most and has at most
    ``centroids`` centroids, which bounds what tasks hold; every vector is indexed. There
    are half as many lists as the root of the number of vectors, so that a query's rows
    and its candidates grow alike."""

    sample_rows: int = 16_384
    centroids: int = 4_096
    replicas: int = 6
    closure: float = 1.15
    degree: int = 16
    recall: float = 0.95
    probes: int = 200
    chunk: int = 8_192
    seed: int = 5


def balanced_parts(rows: np.ndarray, size: int, random: np.random.Generator) -> list[np.ndarray]:
    """Row indices in parts of about equal cardinality, at most ``size`` each."""
    pending, done = [np.arange(len(rows))], []
    while pending:
        part = pending.pop()
        if len(part) <= size:
            done.append(part)
            continue
        own = rows[part]
        centres = own[random.choice(len(part), 2, replace=False)]
        for _ in range(6):  # the median between the centres keeps both halves equal
            along = own @ (centres[1] - centres[0])
            order = np.argsort(along, kind="stable")
            low, high = order[: len(order) // 2], order[len(order) // 2:]
            centres = np.stack([own[low].mean(axis=0), own[high].mean(axis=0)])
        pending += [part[low], part[high]]
    return done


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum(
        (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(axis=1)[None, :], 0
    )


def neighbour_graph(centroids: np.ndarray, degree: int, random: np.random.Generator) -> np.ndarray:
    """Each centroid's neighbours: its nearest ones, and far ones that keep the graph in one piece."""
    count = len(centroids)
    near = min(degree, count - 1)
    if near <= 0:
        return np.zeros((count, 1), np.int64)
    nearest = []
    for at in range(0, count, 512):
        d = _distances(centroids[at:at + 512], centroids)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        nearest.append(np.argpartition(d, near - 1, axis=1)[:, :near])
    ring = random.permutation(count)  # a closed walk through all centroids, both ways
    follows, precedes = np.empty(count, np.int64), np.empty(count, np.int64)
    follows[ring], precedes[np.roll(ring, -1)] = np.roll(ring, -1), ring
    far = random.integers(0, count, (count, 4))
    return np.concatenate([np.concatenate(nearest), follows[:, None], precedes[:, None], far], axis=1)


@dataclass(frozen=True)
class Index:
    longest: float
    centroids: np.ndarray
    graph: np.ndarray
    ratio: float
    width: int
    usual: float  # the median squared distance of a query to its nearest centroid; less counts as that
    settings: Settings

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (rows * rows).sum(axis=1), 0)
        return np.concatenate([rows, np.sqrt(rest)[:, None]], axis=1)

    def search(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` centroids found nearest to each row, nearest first, with squared distances.

        All rows walk the graph at once: each expands its nearest unvisited centroids
        until the best ``width`` it knows are all visited.
        """
        count = len(self.centroids)
        width = min(width, count)
        squares = (self.centroids * self.centroids).sum(axis=1)
        own = (rows * rows).sum(axis=1)
        at_once = max(4, width // 8)
        distance = np.full((len(rows), count), np.inf)
        visited = np.zeros((len(rows), count), bool)
        entry = np.unique(np.linspace(0, count - 1, min(count, 16)).astype(np.int64))
        distance[:, entry] = own[:, None] - 2 * rows @ self.centroids[entry].T + squares[entry]
        active = np.arange(len(rows))
        while len(active):
            near = distance[active]
            best = np.argpartition(near, width - 1, axis=1)[:, :width]
            known = np.take_along_axis(near, best, axis=1)
            open_ = ~np.take_along_axis(visited[active], best, axis=1) & np.isfinite(known)
            going = open_.any(axis=1)
            active, best, known, open_ = active[going], best[going], known[going], open_[going]
            if not len(active):
                break
            order = np.argsort(np.where(open_, known, np.inf), axis=1)[:, :at_once]
            taken = np.take_along_axis(best, order, axis=1)
            valid = np.take_along_axis(open_, order, axis=1)
            row, column = np.nonzero(valid)
            node = taken[row, column]
            visited[active[row], node] = True
            beyond = self.graph[node]
            who = np.repeat(active[row], beyond.shape[1])
            flat = beyond.ravel()
            fresh = np.isinf(distance[who, flat])
            who, flat = who[fresh], flat[fresh]
            for at in range(0, len(flat), 200_000):
                w, f = who[at:at + 200_000], flat[at:at + 200_000]
                distance[w, f] = own[w] - 2 * np.einsum("ij,ij->i", rows[w], self.centroids[f]) + squares[f]
        order = np.argsort(distance, axis=1, kind="stable")[:, :width]
        return order, np.maximum(np.take_along_axis(distance, order, axis=1), 0)

    def lists_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lists hold which rows: the nearest, and further ones of boundary rows."""
        order, squared = self.search(rows, 2 * self.settings.replicas)
        limit = squared[:, :1] * self.settings.closure**2
        taken = (squared <= limit) & (np.arange(order.shape[1]) < self.settings.replicas)
        row, column = np.nonzero(taken)
        return row, order[row, column]

    def in_steps(self, lists, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``lists`` (one of the methods here) of all rows, some at a time."""
        step = max(32, 1_000_000 // len(self.centroids))
        found = [(at, lists(rows[at:at + step])) for at in range(0, len(rows), step)]
        return np.concatenate([at + r for at, (r, _) in found]), np.concatenate([h for _, (_, h) in found])

    def lists_for(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lists each query searches: those within the ratio of its nearest centroid."""
        order, squared = self.search(queries, self.width)
        keep = squared <= np.maximum(squared[:, :1], self.usual) * self.ratio**2
        keep[:, :4] = True
        row, column = np.nonzero(keep)
        return row, order[row, column]


def fit(sample: np.ndarray, longest: float, count: int, k: int, settings: Settings = Settings()) -> Index:
    """An index for ``count`` vectors from a sample of them."""
    random = np.random.default_rng(settings.seed)
    draft = Index(longest, np.zeros((0, 0)), np.zeros((0, 0)), np.inf, 1, 0.0, settings)
    lifted = draft.lifted(sample)
    wanted = max(1, min(settings.centroids, int(np.sqrt(count) / 2)))
    parts = balanced_parts(lifted, max(2, -(-len(sample) // wanted)), random)
    centroids = np.stack([lifted[p].mean(axis=0) for p in parts])
    graph = neighbour_graph(centroids, settings.degree, random)
    index = Index(longest, centroids, graph, np.inf, len(centroids), 0.0, settings)
    # How far true neighbours' lists are, against the nearest list, on part of the sample.
    asked = random.choice(len(sample), min(settings.probes, len(sample)), replace=False)
    queries = np.concatenate([sample[asked], np.zeros((len(asked), 1))], axis=1)
    scores = queries[:, :-1] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    row, held = index.in_steps(index.lists_of, lifted)
    to = _distances(queries, centroids)
    usual = float(np.median(to.min(axis=1)))
    nearest = np.maximum(to.min(axis=1, keepdims=True), usual)
    rank = np.argsort(np.argsort(to, axis=1), axis=1)
    needed, places = [], []
    lists: dict[int, list[int]] = {}
    for r, h in zip(row.tolist(), held.tolist()):
        lists.setdefault(r, []).append(h)
    for q in range(len(asked)):
        for t in true[q].tolist():
            best = min(lists[t], key=lambda h: to[q, h])
            needed.append(np.sqrt(to[q, best] / max(nearest[q, 0], 1e-300)))
            places.append(rank[q, best])
    if not needed:
        return index
    ratio = float(np.quantile(needed, settings.recall, method="higher")) + 1e-9
    within = (to <= nearest * ratio**2).sum(axis=1)
    width = int(max(np.quantile(places, settings.recall, method="higher") + 1, np.quantile(within, 0.95), 8))
    return Index(longest, centroids, graph, ratio, min(len(centroids), width), usual, settings)


# Finds that a searching task holds at most before it hands them on.
HELD = 1_000_000

SEARCHED = "query_id bigint, vec_id bigint, score double"


def nearest(rows: DataFrame, queries: DataFrame, k: int, settings: Settings = Settings(),
            id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row of ``queries``.

    Nearest first by inner product in doubles, ties to the smaller id. Both tables
    have ``vec_id`` and ``embedding``; a query's own id is no candidate, and rows
    that repeat id and vector count once. Rows that take no part (see
    ``vectors.comparable``) neither ask nor answer. Other columns are not read.
    """
    valid = vectors.comparable(rows, id_column, vector_column)
    first = Window.partitionBy("vector").orderBy("vec_id")
    members = written(
        valid.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1), "members"
    )
    distinct = written(members.where("place = 1").select("vec_id", "vector"), "vectors")
    asked = written(vectors.comparable(queries, id_column, vector_column).distinct(), "queries")
    count = distinct.count()
    if not count or asked.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(np.sqrt(distinct.agg(F.max(size)).first()[0]))
    index = fit(vectors.sample(distinct, settings.sample_rows), longest, count, k, settings)
    shared = rows.sparkSession.sparkContext.broadcast(index)  # at most ``centroids`` of them
    chunks = max(1, -(-count * settings.replicas // (len(index.centroids) * settings.chunk)))

    def dealt(of: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                vector = matrix(batch.column("vector"))
                if of == "posting":
                    row, held = index.in_steps(index.lists_of, index.lifted(vector))
                else:
                    row, held = index.in_steps(
                        index.lists_for, np.concatenate([vector, np.zeros((len(vector), 1))], axis=1)
                    )
                for at in range(0, len(row), 10_000):  # a question goes to many lists
                    taken = batch.take(pa.array(row[at:at + 10_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(held[at:at + 10_000]), taken.column("vec_id"), taken.column("vector")],
                        ["list", "vec_id", "vector"],
                    )

        return run

    schema = "list bigint, vec_id bigint, vector array<double>"
    postings = (
        distinct.mapInArrow(dealt("posting"), schema)
        .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("asks", F.lit(0))
    )
    questions = (
        asked.select("vec_id", "vector").repartition("vec_id").mapInArrow(dealt("question"), schema)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("asks", F.lit(1))
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ("list", "chunk")
        hits: list[tuple] = []

        def merged() -> tuple:
            query, found, score = (np.concatenate(x) for x in zip(*hits))
            keep = _leading(query, found, score, k + 1)
            return query[keep], found[keep], score[keep]

        for table in whole_units(batches, keys, 4_000):
            ids, asks = table.column("vec_id").to_numpy(), table.column("asks").to_numpy()
            values = matrix(table.column("vector"))
            starts = unit_starts(table, keys)
            for start, end in zip(starts, np.append(starts[1:], len(ids))):
                middle = start + int(np.searchsorted(asks[start:end], 1))
                held, candidates = values[start:middle], ids[start:middle]
                if not len(candidates):
                    continue
                for at in range(middle, end, 256):
                    scores = values[at:min(end, at + 256)] @ held.T
                    most = min(k + 1, len(candidates))
                    if most < len(candidates):  # ties at the last place stay; the final order cuts them
                        last = -np.partition(-scores, most - 1, axis=1)[:, most - 1:most]
                        q, c = np.nonzero(scores >= last)
                    else:
                        q, c = np.indices(scores.shape).reshape(2, -1)
                    hits.append((ids[at + q], candidates[c], scores[q, c]))
            # A query's best of all lists of this task; what is kept meanwhile is bounded.
            if sum(len(h[0]) for h in hits) > HELD:
                hits = [merged()]
                if len(hits[0][0]) > HELD // 2:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, hits[0])), ["query_id", "vec_id", "score"])
                    hits = []
        if hits:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, merged())), ["query_id", "vec_id", "score"])

    together = postings.unionByName(questions).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "asks")
    hits = together.select("list", "chunk", "asks", "vec_id", "vector").mapInArrow(searched, SEARCHED)
    # A vector may be found in several lists.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = (
        hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
        .select("query_id", F.col("vec_id").alias("class"), "score")
    )
    classed = members.withColumn("class", F.min("vec_id").over(Window.partitionBy("vector"))).select("class", "vec_id")
    return (
        written(best, "hits").join(classed, "class").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _leading(query: np.ndarray, found: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Indices of each query's ``most`` best distinct finds, ties to the smaller id."""
    order = np.lexsort((found, -score, query))
    q, f = query[order], found[order]
    distinct = np.append(True, (q[1:] != q[:-1]) | (f[1:] != f[:-1]))
    order, q = order[distinct], q[distinct]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[place < most]
