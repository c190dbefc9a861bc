from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest

from netdays.llm import langid, pitman_yor, quality

LANGUAGES = {"en": "the of and that with house from".split(), "de": "der und nicht haus für eine zu".split(), "fr": "le une maison dans étre que pour".split()}


def sentences(count: int) -> list[tuple[int, str, str]]:
    chance = random.Random(6)
    return [
        (i, " ".join(chance.choice(LANGUAGES[lang]) for _ in range(chance.randint(5, 30))), lang)
        for i in range(count) for lang in [chance.choice(sorted(LANGUAGES))]
    ]


def test_languages_of_rows_that_were_not_learned(docs):
    rows = sentences(600)
    model = langid.fit(docs(rows[:400]))
    right = {i: lang for i, _, lang in rows}
    odd = [(900, None, None), (901, "", None), (902, "12 !? 34", None), (None, "the house", None), (903, "der " * 400_000, None)]
    found = langid.predict(docs([*rows[400:], *odd]), model).collect()
    assert len(found) == 205
    by = {r["doc_id"]: r for r in found}
    assert np.mean([by[i]["lang_pred"] == right[i] for i, _, _ in rows[400:]]) >= 0.99
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert by[903]["lang_pred"] == "de" and by[None]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in found)
    nothing = langid.predict(docs(rows[:3]), langid.fit(docs([(1, "x", None)]))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    kept = langid.identified(docs(rows[:9]), model, "guess", "chance")
    assert kept.columns == [*docs([]).columns, "guess", "chance"] and kept.count() == 9


def test_frequencies_count_every_row_and_chunks_do_not_matter(docs, monkeypatch):
    settings = langid.Settings()
    rows = sentences(50)
    got = {r["bucket"]: r["documents"] for r in langid.document_frequencies(docs(rows), settings).collect()}
    expected = collections.Counter(int(b) for _, t, _ in rows for b in np.flatnonzero(langid.grams(t, settings)))
    assert got.pop(-1) == 50 and got == dict(expected)
    whole = langid.grams("Été  à la maison, 12 fois!", settings)
    monkeypatch.setattr(langid, "CHUNK", 3)
    assert (langid.grams("Été  à la maison, 12 fois!", settings) == whole).all()


def test_penalties_make_weights_sparse():
    chance = np.random.default_rng(0)
    rows = [(np.array([k % 2, *chance.choice(np.arange(10, 200), 5, replace=False)]), np.full(6, 0.4), k % 2) for k in range(300)]
    weights = langid.fit_weights(rows, 2, langid.Settings(buckets=256, l1=0.5))
    assert weights[0, 0] > 0 > weights[1, 0] and np.mean(weights[10:200] == 0) > 0.5
    sharp = langid.fit_temperature(np.array([[9.0, 0.0]] * 3 + [[0.0, 9.0]]), np.array([0, 0, 0, 0]))
    assert sharp > 1


def test_quality_of_documents_that_were_not_learned(llm, docs):
    chance = random.Random(9)
    good = lambda n: " ".join(chance.choice(sum(LANGUAGES.values(), [])) for _ in range(n))
    bad = lambda n: " ".join(chance.choice("ab") + chance.choice(["$$$", "###"]) for _ in range(n))
    rows, labels = [], []
    for i in range(700):
        label = i % 4 != 0
        rows.append((i, good(chance.randint(5, 600)) if label else bad(chance.randint(5, 400))))
        labels.append((i, int(label)))
    labels += [(None, 1), (3, None), (5, 1)]
    model = quality.fit(docs(rows[:500]), llm.createDataFrame(labels[:500] + labels[-3:], "doc_id bigint, quality int"))
    odd = [(900, None), (901, ""), (None, good(9)), (902, bad(300_000))]
    found = quality.scored(docs([*rows[500:], *odd]), model).collect()
    assert len(found) == 204
    score = {r["doc_id"]: r["score"] for r in found}
    assert all(0 <= s <= 1 for s in score.values()) and score[902] < 0.3
    assert np.mean([(score[i] >= 0.3) == bool(label) for i, label in labels[500:700]]) >= 0.97
    nothing = quality.scored(docs(rows[:2]), quality.fit(docs(rows), llm.createDataFrame([], "doc_id bigint, quality int"))).collect()
    assert [r["score"] for r in nothing] == [0.5, 0.5]


def test_attention_is_summed_part_by_part(monkeypatch):
    chance = np.random.default_rng(1)
    settings = quality.Settings(epochs=1, hidden=4, attention=3)
    bags = [chance.random((n, quality.FEATURES)).astype(np.float32) for n in (1, 3, 2, 5)]
    model = quality.fit_bags(bags, np.array([0.0, 1.0, 1.0, 0.0]), settings)
    text = "".join(chance.choice(list("ab c\n$é"), 9_500))
    whole = model.score(text, settings)
    monkeypatch.setattr(quality, "CHUNK", 2_000)
    assert model.score(text, settings) == pytest.approx(whole, rel=1e-5)


def plain_counts(rows):
    counts = collections.Counter()
    for _, text in rows:
        counts.update([*(text or "").encode().lower().split(), None])
    return counts


def test_language_model_counts_and_scores(docs):
    chance = random.Random(3)
    rows = []
    for i in range(150):  # what follows a word depends on it
        text = []
        for _ in range(chance.randint(0, 25)):
            text += chance.choice([["The", f"house{chance.randrange(9)}"], ["of", f"w{chance.randrange(60)}ed"], ["Ä", "ß"]])
        rows.append((i, " ".join(text)))
    rows += [(200, None), (201, ""), (202, "unseen words only"), (203, "the " * 3_000), (None, "the")]
    training = rows[:120]
    model, words = pitman_yor.fit(docs(training), pitman_yor.Settings(frequent=0.02))
    counts = plain_counts(training)
    total, size = sum(counts.values()), len(counts)
    assert (model.corpus.tokens, model.corpus.words) == (total, size)
    found = pitman_yor.scored(docs(rows), model, words).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    for key, text in rows:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(np.log10((counts[t] + 1) / (total + size + 1)) for t in tokens)
        assert (by[key]["n_tokens"], by[key]["n_known"]) == (len(tokens), sum(t in counts for t in tokens))
        assert by[key]["base_score"] == pytest.approx(base, rel=1e-9)
    held = [by[key] for key, _ in rows[120:150]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # Shared words and joined ones score alike.
    other = {r["doc_id"]: r["score"] for r in pitman_yor.scored(docs(rows), pitman_yor.Model(model.corpus, model.samples, pitman_yor.Settings(frequent=0.5)), words).collect()}
    assert all(by[k]["score"] == pytest.approx(other[k], rel=1e-5) for k, _ in rows)


def test_chances_sum_to_one(docs):
    rows = [(i, t) for i, t, _ in sentences(60)]
    model, words = pitman_yor.fit(docs(rows))
    total = model.unknown().copy()
    for r in words.collect():
        total += np.array(r["parent"]) @ model.back_off()
        for context, seen in zip(r["contexts"], r["seen"]):
            total[context] += seen
    assert np.allclose(total, 1)


def test_tokens_do_not_depend_on_parts(monkeypatch):
    rows = ["The house of\tthe  sun", "", "one", "x " * 50]
    whole = [np.concatenate(x) for x in zip(*pitman_yor.tokens(rows))]
    monkeypatch.setattr(pitman_yor, "CHUNK", 7)
    parts = [np.concatenate(x) for x in zip(*pitman_yor.tokens(rows))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_seats():
    chance = np.random.default_rng(5)
    key = chance.integers(0, 2**63, 20_000).astype(np.uint64)
    tables = pitman_yor.seated(np.full(20_000, 12), np.full(20_000, 0.7), 0.4, key)
    assert ((tables >= 1) & (tables <= 12)).all()
    slow = []
    for _ in range(4_000):
        t = 1
        for i in range(1, 12):
            t += chance.random() < 0.7 / (0.7 + i - 0.4 * t)
        slow.append(t)
    assert tables.mean() == pytest.approx(np.mean(slow), abs=0.08)


def test_every_customer_draws_a_seat(monkeypatch):
    """Tables of dishes with many customers spread as they do when seated one after the other."""
    chance = np.random.default_rng(6)
    size, customers, discount = 1_500, 2_000, 0.6
    key = chance.integers(0, 2**63, size).astype(np.uint64)
    weight, per_table = np.full(size, 2.0), np.full(size, 0.02)
    tables = pitman_yor.seated(np.full(size, customers), weight, discount, key)
    plain, grown = np.ones(size), np.ones(size)
    for i in range(1, customers):
        plain += chance.random(size) < 2.0 / (2.0 + i - discount * plain)
        w = weight + per_table * grown
        draw = pitman_yor._uniform(key, i)
        grown += draw * (w + i - discount * grown) < w
    assert tables.mean() == pytest.approx(plain.mean(), abs=0.5)
    assert tables.std() == pytest.approx(plain.std(), rel=0.1)
    # The same draws give the same tables, in runs of any size.
    for run in (1 << 18, 100):
        monkeypatch.setattr(pitman_yor, "CUSTOMERS", run)
        mixed = pitman_yor.seated(np.full(size, customers), weight, discount, key, per_table)
        assert (mixed == grown).all()


def test_empty_tables_of_models(llm, docs):
    assert langid.predict(docs([]), langid.fit(docs([]))).collect() == []
    assert quality.scored(docs([]), None).collect() == []
    model, words = pitman_yor.fit(docs([]))
    assert pitman_yor.scored(docs([]), model, words).collect() == []
    assert pitman_yor.scored(docs([(1, "a b")]), model, words).first()["n_known"] == 0


def test_remainders_match_crc(llm):
    from netdays.llm.common import remainder

    rows = llm.range(50).withColumnRenamed("id", "doc_id").select("doc_id", remainder("doc_id", 7).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in rows)
