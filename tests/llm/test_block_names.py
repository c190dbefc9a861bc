"""Block naming against plain grouping of the same texts."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from netdays.llm import block_names


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    """``(doc_id, keep_id, group_size, sha256)`` of each row, sorted."""
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[plain(t)].append((-len(t or ""), d is None, d))
    found = []
    for d, t in rows:
        members = groups[plain(t)]
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        found.append((d, keep, len(members), hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(found, key=repr)


def check(found, rows):
    got = found.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == expected(rows)
    stays = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert stays == {r["text_sha256"]: 1 for r in got}
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


ROWS = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " \x0b\r"), (7, "a b"), (8, "abc" * 40),
    (9, "abc" * 40 + "x"), (10, "x" + "abc" * 40), (11, " ".join("abc" * 40)), (None, "ab"), (None, "only here"),
    (1, "a b"), (12, "дом😀" * 9), (13, "дом 😀" * 9), (14, "ab\x00"), (15, "abab"), (16, "abababab"), (17, "ababab"),
]


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_small_texts(llm, docs, size):
    check(block_names.exact_groups(docs(ROWS), size=size), ROWS)


def test_labels_that_collide_are_drawn_again(llm, docs):
    draws = []

    def weak(block, draw):
        draws.append(draw)
        return (F.length(block).cast("bigint"), F.lit(0)) if draw < 2 else block_names.label(block, draw)

    check(block_names.exact_groups(docs(ROWS), size=3, labels=weak), ROWS)
    assert max(draws) == 2


def test_random_texts_with_a_hot_group(llm, docs):
    chance = random.Random(11)
    rows = [(i, "".join(chance.choices("ab ", k=chance.randint(0, 9)))) for i in range(200)]
    rows += [(1000 + i, "the same long text " * 30 + " " * (i % 3)) for i in range(100)]
    check(block_names.exact_groups(docs(rows), size=2), rows)


def test_empty_table_and_other_columns(llm, docs):
    assert block_names.exact_groups(docs([])).collect() == []
    clashing = docs([(1, "a b"), (2, "ab"), (3, None)]).withColumnsRenamed({"component": "name", "rank": "row", "start": "level"})
    clashing = clashing.withColumn("kept", F.lit("x")).withColumn("carry", F.lit(1))
    found = block_names.without_copies(clashing)
    assert found.columns == clashing.columns
    assert sorted((r["doc_id"], r["text"], r["kept"]) for r in found.collect()) == [(1, "a b", "x"), (3, None, "x")]


def test_other_equality(llm, docs):
    lower = block_names.exact_groups(docs([(1, "AB"), (2, "ab"), (3, "a b")]), F.lower("text"))
    assert {r["doc_id"]: r["group_size"] for r in lower.collect()} == {1: 2, 2: 2, 3: 1}


def test_main_path_has_no_python(llm, docs):
    plan = block_names.exact_groups(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
