"""Contexts of the language model are whole words, and how dishes are dealt changes nothing."""

from __future__ import annotations

import random

import numpy as np
import pytest

from netdays.llm import pitman_yor


def followed(count: int) -> list[tuple[int, str]]:
    """Words of one ending; which word follows depends on the whole of the one before."""
    chance = random.Random(11)
    return [
        (i, " ".join(f"{x}ing after{x}" for x in (chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12))))
        for i in range(count)
    ]


def test_a_context_is_the_whole_previous_word():
    rows, words, contexts = (np.concatenate(x) for x in zip(*pitman_yor.tokens(["one aing x bing x aing y", "x"])))
    text = contexts[rows == 0]
    assert text[0] == pitman_yor.START
    assert (text[1:] == words[rows == 0][:-1]).all()
    assert text[2] == text[6] != text[4]
    assert contexts[rows == 1][0] == pitman_yor.START


def test_words_are_learned_by_the_word_before(docs):
    rows = followed(80)
    model, words = pitman_yor.fit(docs(rows[:60]))
    held = pitman_yor.scored(docs(rows[60:]), model, words).collect()
    tokens = sum(r["n_tokens"] for r in held)
    # Half of the words can be told for sure, the others are one of 26.
    assert 10 ** (-sum(r["score"] for r in held) / tokens) < 9
    assert 10 ** (-sum(r["base_score"] for r in held) / tokens) > 30


def test_scores_are_the_chances_of_the_words(docs):
    rows = [*followed(12), (90, "unseen aing aftera"), (91, None), (92, "aftera aftera bing")]
    model, words = pitman_yor.fit(docs(rows[:12]))
    back_off, unknown = model.back_off(), model.unknown()
    number = {r["context"]: r["number"] for r in model.samples.contexts.collect()}
    table = {r["word"]: r for r in words.collect()}
    as_id = lambda h: int(np.uint64(h).view(np.int64))
    chance_unknown = pitman_yor._unknown(model.corpus, model.samples.totals, model.settings)
    for r in pitman_yor.scored(docs(rows), model, words).collect():
        text = dict(rows)[r["doc_id"]] or ""
        _, word, context = (np.concatenate(x) for x in zip(*pitman_yor.tokens([text])))
        score = 0.0
        for w, c in zip(map(as_id, word), map(as_id, context)):
            known, at = table.get(w), number.get(c)
            weight = back_off[:, at] if at is not None else np.full(len(back_off), 1 / len(back_off))
            chance = weight @ (np.array(known["parent"]) if known else chance_unknown)
            if known and at in known["contexts"]:
                chance += known["seen"][known["contexts"].index(at)]
            score += np.log10(chance)
        assert r["score"] == pytest.approx(score, rel=1e-9)
    assert len(unknown) == len(number)


def test_units_change_no_score(docs, monkeypatch):
    """Many units, words dealt over several of them, words without a code and none."""
    rows = [*followed(40), (99, "unseen aing only zing unseen"), (None, "aftera")]
    scores = []
    for unit, codes in ((1 << 23, 0xFFFF), (400, 0xFFFF), (400, 7)):
        monkeypatch.setattr(pitman_yor, "UNIT", unit)
        monkeypatch.setattr(pitman_yor, "CODES", codes)
        model, words = pitman_yor.fit(docs(rows[:30]))
        scores.append({r["doc_id"]: tuple(r) for r in pitman_yor.scored(docs(rows), model, words).collect()})
        assert len(scores[-1]) == len(rows)
    assert model.samples.layout.units > 10 and (model.samples.layout.spread > 1).any()
    for other in scores[1:]:
        for key, row in scores[0].items():
            assert row[:3] == other[key][:3]
            assert row[3:] == pytest.approx(other[key][3:], rel=1e-9)


def test_packed_numbers():
    values = np.array([0, 254, 255, 256, 10**12, 1])
    assert (pitman_yor._unpacked(pitman_yor._packed(values), 6) == values).all()
    layout = pitman_yor.Layout(5, np.array([3, 8], np.uint64), np.array([1, 0]), np.array([8, 3], np.uint64), np.ones(2, np.uint64))
    hashes = np.array([8, 2**63, 3, 3], np.uint64)
    assert (layout.decoded(layout.coded(hashes)) == hashes).all()
    word, context, n = np.array([3, 3, 9], np.uint64), np.array([8, 1, 3], np.uint64), np.array([1, 700, 2])
    assert all((a == b).all() for a, b in zip(layout.unpack(layout.pack(word, context, n)), (word, context, n)))
    assert len(layout.decoded(layout.coded(hashes[:0]))) == 0
