"""The registered queries by their contracts, and the pipeline against plain Python."""

from __future__ import annotations

import collections
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_simhash import plain_components, plain_fingerprint
from test_texts import plain_repeats
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from netdays.llm import surrogates

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_itq_neardup": ["vec_id", "n_links", "component_id", "kept"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6_surrogates": ["doc_id", "text", "n_entities"],
    "op7_pitman_yor": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_suffix_array": ["doc_id", "start", "end", "n_words", "first_doc_id", "kept"],
    "op10_posting_lists": ["query_id", "rank", "vec_id", "score"],
}


def test_all_are_registered():
    names = set(registry.queries())
    assert set(COLUMNS) | {"pipeline"} <= names
    assert not (set(COLUMNS) | {"pipeline"}) & set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(llm, small, name):
    found = registry.queries()[name](llm, SF)
    assert found.columns == COLUMNS[name]
    rows = found.collect()
    if name in ("op1_language_id", "op2_quality", "op4_simhash", "op6_surrogates", "op7_pitman_yor", "op8_sentencepiece"):
        assert len(rows) == small.count()
    if "held_out" in found.columns:
        divisor, wanted = {"op1": (4, 2), "op2": (5, 0), "op7": (7, 2)}[name.split("_")[0]]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == wanted) for r in rows)


def test_pipeline_against_plain_python(llm, small):
    texts = {r["doc_id"]: r["text"] for r in small.collect() if any(c.isalpha() for c in r["text"] or "")}
    marks = {d: plain_fingerprint(t) for d, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(marks, 2) if (marks[a] ^ marks[b]).bit_count() <= 3]
    texts = {d: t for d, t in texts.items() if plain_components(marks, links)[d] == d}
    removed = plain_repeats(texts, 50)
    library, plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    for d, text in texts.items():
        left, at = "", 0
        for start, end in removed.get(d, []):
            left, at = left + text[at:start], end
        left += text[at:]
        if not re.search(r"[0-9@=:]", left):  # surely no personal data
            plain[d] = np.array([*library.encode(left, add_special_tokens=False).ids, 1], "<u4")
    pieces = collections.defaultdict(list)
    places = collections.defaultdict(list)
    for r in corpus_pipeline.run(llm, SF).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts) and len(plain) > 50
    for d, ids in plain.items():
        assert [(s, n, zlib.crc32(ids[s:s + n].tobytes())) for s, n, _ in sorted(pieces[d])] == sorted(pieces[d])
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1]] and sum(held[-1]) <= 4096


def test_corpora_without_a_language_stay(llm, docs):
    rows = [(1, "the house"), (2, None), (3, ""), (4, "12 !"), (None, "дом"), (5, "3 é"), (5, "3 é")]
    found = corpus_pipeline.language(llm, docs(rows), SF)
    assert found.schema.names == docs(rows).schema.names
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found.collect()) == [(0, "дом"), (1, "the house"), (5, "3 é"), (5, "3 é")]
    # A language that is called like none is one.
    called = corpus_pipeline.language(llm, docs([(1, "the house", "und"), (2, "12", "und"), (3, "der", None)]), SF)
    assert sorted(r["doc_id"] for r in called.collect()) == [1, 3]


def test_stages_keep_columns_nulls_and_empty_tables(llm, docs):
    rows = [(1, "the house of 1.2.3.4 and a@b.example.org", "en"), (2, None, None), (3, "", "en"), (4, "12", None), (None, "und so weiter", "de")]
    for table in (docs(rows), docs([])):
        for name, stage in corpus_pipeline.STAGES[:4]:
            found = stage(llm, table, SF)
            assert found.columns == table.columns, name
            ids = [r["doc_id"] for r in found.collect()]
            # Two rows have a letter; the null and the empty text have one fingerprint.
            assert len(ids) == min(table.count(), {"language_id": 2, "simhash": 4}.get(name, 5))
        assert {r["doc_id"] for r in corpus_pipeline.packed(llm, table, SF).collect()} == {r["doc_id"] for r in table.collect()}
    cleaned = {r["doc_id"]: r["text"] for r in corpus_pipeline.personal_data(llm, docs(rows), SF).collect()}
    assert "1.2.3.4" not in cleaned[1] and cleaned[None] == "und so weiter" and len(surrogates.PATTERNS) == 9
