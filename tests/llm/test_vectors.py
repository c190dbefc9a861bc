from __future__ import annotations

import numpy as np
import pytest

from netdays.llm import itq, posting_lists

SCHEMA = "vec_id bigint, embedding array<double>, label int, component string"


@pytest.fixture(scope="module")
def clustered():
    """Vectors with groups of near and equal ones."""
    random = np.random.default_rng(4)
    rows = random.standard_normal((300, 24))
    near = np.repeat(rows[:12], 8, axis=0) + random.standard_normal((96, 24)) * np.repeat([0.02, 0.06, 0.1, 0.14], 24)[:, None]
    return np.concatenate([rows, near, np.repeat(rows[:3], 20, axis=0) * 2.0])


def frame(llm, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return llm.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in zip(ids, vectors)], SCHEMA)


@pytest.mark.parametrize("chunk", [4_096, 16])
def test_links_are_those_of_all_pairs(llm, clustered, chunk):
    unit = clustered / np.linalg.norm(clustered, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    component = np.arange(len(unit))
    for _ in range(len(unit)):
        lowest = np.where(linked, component[None, :], len(unit)).min(axis=1)
        component = np.minimum(component, lowest)
    found = {r["vec_id"]: r for r in itq.near_components(frame(llm, clustered), itq.Settings(chunk=chunk)).collect()}
    assert [found[i]["n_links"] for i in range(len(unit))] == linked.sum(axis=1).tolist()
    assert [found[i]["component_id"] for i in range(len(unit))] == component.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


@pytest.mark.parametrize("size, rank", [(64, 64), (256, 48), (768, 100)])
def test_radius_reaches_pairs_of_the_datas_own_directions(size, rank):
    random = np.random.default_rng(size)
    basis = random.standard_normal((rank, size))
    unit, noise = (random.standard_normal((4_000, rank)) @ basis for _ in range(2))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    noise -= (noise * unit).sum(axis=1, keepdims=True) * unit
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    codes = itq.learn(unit)
    apart = np.bitwise_count(codes.of(unit) ^ codes.of(0.95 * unit + np.sqrt(1 - 0.95**2) * noise))
    assert (apart > codes.radius).mean() <= 0.004


def test_vectors_that_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [2, 0], None, [0, 0], [nan, 1], [None, 1], [inf, 1], [], [1, 0, 0], [1, 0], [1, 0]]
    ids = [4, 3, 5, 6, 7, 8, 9, 10, 11, None, 4]
    rows = sorted(
        ((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in itq.near_components(frame(llm, vectors, ids)).collect())
    )
    assert rows == [(0, 0, 0, False), (3, 2, 3, True), (4, 2, 3, False), (4, 2, 3, False)] + [(i, 0, i, True) for i in range(5, 12)]
    assert itq.near_components(frame(llm, [])).collect() == []
    asked = posting_lists.nearest(frame(llm, vectors, ids), frame(llm, vectors, ids), 3).collect()
    assert sorted(tuple(r) for r in asked) == [(3, 1, 4, 2.0), (4, 1, 3, 2.0)]
    assert posting_lists.nearest(frame(llm, []), frame(llm, []), 3).collect() == []


def test_recall_and_order(llm):
    random = np.random.default_rng(8)
    vectors = np.concatenate([random.standard_normal((1_500, 16)), np.repeat(random.standard_normal((2, 16)), 60, axis=0)])
    rows = frame(llm, vectors)
    found: dict[int, list] = {}
    for r in posting_lists.nearest(rows, rows.where("vec_id % 20 = 0"), 20).collect():
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == set(range(0, len(vectors), 20))
    hits = []
    for query, got in found.items():
        got.sort(key=lambda r: r["rank"])
        score = vectors @ vectors[query]
        score[query] = -np.inf
        true = np.lexsort((np.arange(len(score)), -np.round(score, 9)))[:20]
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert np.allclose([r["score"] for r in got], [score[r["vec_id"]] for r in got], atol=1e-9)
        hits.append(len(set(true) & {r["vec_id"] for r in got}) / 20)
    assert np.mean(hits) >= 0.9
    # All of a query's equals tie; the smallest ids come first.
    assert [r["vec_id"] for r in found[1_500]] == list(range(1_501, 1_521))
