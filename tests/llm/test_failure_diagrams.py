"""Filter overlaps against applying the filters one after the other."""

from __future__ import annotations

import collections
import itertools
import random
import re

import pytest

from netdays.llm import failure_diagrams as fd


def plain_masks(rows):
    """Failing letters of ``(doc_id, text, lang)`` rows."""
    found = []
    for d, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in rows),
        }
        found.append({k for k, v in fails.items() if v})
    return found


def plain_report(rows, labels):
    """The contract's rows by applying every order to every document."""
    masks = plain_masks(rows)
    report = {}
    for part in {lang or "" for _, _, lang in rows}:
        members = [(d, m) for (d, _, lang), m in zip(rows, masks) if (lang or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                report[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in m for _, m in members) - len(gone),
                    sum(m == {letter} for _, m in members), *(sum(labels.get(d, (0, 0))[k] == 1 for d, _ in gone) for k in (0, 1)), letter,
                ]
        for key in report:
            if key[0] == part:
                report[key][-1] = shapley[report[key][-1]]
    return report


def got(report):
    rows = report.collect()
    table = {
        (r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
        for r in rows
    }
    assert len(table) == len(rows)
    return table


@pytest.mark.parametrize("count", range(1, 6))
def test_plain_changes_reach_every_order(count):
    order = list(range(count))
    seen = {tuple(order)}
    for at in fd.plain_changes(count):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert seen == set(itertools.permutations(range(count)))


def test_diagram_stays_reduced_and_right():
    chance = random.Random(12)
    for _ in range(40):
        masks = {m: (chance.randint(1, 3), chance.randint(0, 1)) for m in chance.sample(range(16), chance.randint(1, 16))}
        diagram = fd.Diagram(4, masks)
        for order, steps in diagram.orders():
            passed = 0
            for variable, kept, removed in steps:
                left = [w for m, w in masks.items() if not m & passed]
                gone = [w for m, w in masks.items() if not m & passed and m >> variable & 1]
                passed |= 1 << variable
                assert removed == tuple(sum(w[k] for w in gone) for k in (0, 1))
                assert kept == tuple(sum(w[k] for w in left) - removed[k] for k in (0, 1))
            for level, nodes in enumerate(diagram.levels):
                rests = {
                    tuple(sorted((m & ~sum(1 << v for v in order[:level]), w) for m, w in masks.items()
                                 if m & sum(1 << v for v in order[:level]) == prefix))
                    for prefix in masks for prefix in [prefix & sum(1 << v for v in order[:level])]
                }
                assert len(nodes) == len(rests)


LONG = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG.upper(), "de"), (4, "a " * 200, "en"), (5, None, None), (6, "", "en"), (7, "#", ""),
    (8, LONG + " &", "en"), (None, LONG, "en"), (None, LONG, None), (2, LONG, "en"), (9, LONG.upper(), "en"), (10, "Ä é\x0b\x0cz", "fr"),
    (11, "\x0b" + LONG + "\n", "fr"), (12, LONG + " ABC" * 40, "en"), (0, "Z" * 2000, "en"), (13, "# $", "en"), (14, "   ", "de"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (9, None, 1), (None, 1, 1), (77, 1, 1), (12, 1, None)]


def test_small_corpus(llm, docs):
    labels = llm.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    merged = {}
    for d, q, t in LABELS:
        if d is not None:
            merged[d] = tuple(max(a, b or 0) for a, b in zip(merged.get(d, (0, 0)), (q, t)))
    assert got(fd.corpus_audit(docs(ROWS), labels)) == plain_report(ROWS, merged)


def test_empty_tables(llm, docs):
    labels = llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert fd.corpus_audit(docs([]), labels).collect() == []
    lone = got(fd.corpus_audit(docs([(1, None, None)]), labels))
    assert lone == plain_report([(1, None, None)], {})


def test_hot_part_and_copies(llm, docs):
    chance = random.Random(5)
    rows = [(i, chance.choice([LONG, "A#", "b " * 150, LONG + " X%"]), chance.choice(["en", "en", "en", "de"])) for i in range(300)]
    labels = {i: (i % 3 == 0, i % 5 == 0) for i in range(0, 300, 2)}
    frame = llm.createDataFrame([(d, int(q), int(t)) for d, (q, t) in labels.items()], "doc_id bigint, quality int, toxic int")
    assert got(fd.corpus_audit(docs(rows), frame)) == plain_report(rows, labels)
