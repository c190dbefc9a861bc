from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from netdays.llm import simhash
from netdays.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, links):
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {m: find(m) for m in marks}


TEXTS = [None, "", " \t\n", "one", "ONE", "one two", "a b c", "A b c d", "é É ß", "x " * 5_000, "word " * 3 + "tail"]


def test_fingerprints_agree_with_single_bits(docs, small):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r["simhash"] % 2**64 for r in simhash.fingerprints(docs(rows)).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in rows}
    some = small.limit(40).collect()
    got = {r["doc_id"]: r["simhash"] % 2**64 for r in simhash.fingerprints(small).collect()}
    assert all(got[r["doc_id"]] == plain_fingerprint(r["text"]) for r in some)


@pytest.mark.parametrize("node_limit", [50_000, 8])
def test_trie_links_connect_what_all_pairs_connect(llm, node_limit):
    chance = random.Random(node_limit)
    marks = set()
    for _ in range(60):
        centre = chance.getrandbits(64)
        for _ in range(chance.randint(1, 8)):
            marks.add(centre)
            for _ in range(chance.randint(1, 3)):
                centre ^= 1 << chance.randrange(64)
    # A crowded node: marks that agree on the first block.
    marks |= {0xABCD << 48 | chance.getrandbits(12) for _ in range(80)}
    marks = sorted(marks)
    rows = [(i, int(np.uint64(m).view(np.int64))) for i, m in enumerate(marks)]
    links = [
        (a, b) for (a, x), (b, y) in itertools.combinations(enumerate(marks), 2) if (x ^ y).bit_count() <= 3
    ]
    found = simhash.trie_links(llm.createDataFrame(rows, "id bigint, simhash bigint"), 3, node_limit).collect()
    assert {(min(r), max(r)) for r in found} <= set(links)
    got = plain_components(range(len(marks)), [tuple(r) for r in found])
    assert got == plain_components(range(len(marks)), links)


def test_components_of_the_smallest_table(small):
    found = simhash.simhash_components(small).collect()
    marks = {r["doc_id"]: r["simhash"] % 2**64 for r in found}
    links = [(a, b) for a, b in itertools.combinations(marks, 2) if (marks[a] ^ marks[b]).bit_count() <= 3]
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(marks, links)
    assert len(found) == small.count()


def test_nulls_repeats_and_empty_tables(docs):
    rows = [(5, None), (2, ""), (7, "a b c d"), (7, "a b c d"), (9, "A B C D"), (None, "a b c d"), (3, "quite other words here")]
    found = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.simhash_components(docs(rows)).collect())
    assert found == [(0, 0), (2, 2), (3, 3), (5, 2), (7, 7), (7, 7), (9, 7)]
    kept = simhash.one_of_each(docs(rows))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 7]
    assert kept.columns == docs(rows).columns
    assert simhash.simhash_components(docs([])).collect() == []


def test_ids_that_repeat_with_other_texts(docs):
    other, near, near_too = "quite other words here", "a b c d", "A  B C\td"
    kept = simhash.one_of_each(docs([(5, other), (5, near), (3, near_too), (5, other), (8, other), (8, "and a third of them")]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, near_too), (5, other), (8, "and a third of them")]
    both = simhash.one_of_each(docs([(5, near), (5, near_too), (6, near)])).collect()
    assert len(both) == 1 and both[0]["doc_id"] == 5


def test_components_of_chains_and_stars(llm):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (None, 3)]
    random.Random(1).shuffle(chain)
    found = components(llm.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)}
    assert components(llm.createDataFrame([], "a bigint, b bigint")).collect() == []
