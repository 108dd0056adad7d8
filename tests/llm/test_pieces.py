"""Sampling of segmentations against the exact chances, and round trips."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

from clicklens.llm.pieces import (
    MODEL,
    Lattices,
    Vocabulary,
    decode_pieces,
    lattices,
    sample_batch,
    sample_pieces,
)

pytestmark = pytest.mark.skipif(not Path(MODEL).exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def net():
    return lattices(MODEL, 1.0)


def all_segmentations(model, log_p, text):
    if not text:
        yield (), 0.0
    for n in range(1, len(text) + 1):
        i = model.piece_to_id(text[:n])
        if model.id_to_piece(i) == text[:n]:
            for rest, chance in all_segmentations(model, log_p, text[n:]):
                yield (i, *rest), chance + log_p[i]


def test_draws_follow_the_law_without_replacement(net):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    every = dict(all_segmentations(model, net.vocabulary.log_p, "▁the▁a"))
    total = np.logaddexp.reduce(list(every.values()))
    p = {s: np.exp(v - total) for s, v in every.items()}
    n = 20_000
    rows = sample_batch(net, ["the a"] * n, np.arange(n, dtype=np.uint64), 2)
    drawn = [[tuple(s.pieces.tolist()) for s in row] for row in rows]
    first, second = Counter(r[0] for r in drawn), Counter(r[1] for r in drawn)
    for s in p:
        later = sum(p[f] * p[s] / (1 - p[f]) for f in p if f != s)
        assert abs(first[s] / n - p[s]) < 0.02 and abs(second[s] / n - later) < 0.02
    # weights by inclusion score add up to one
    weights = [sum(np.exp(s.log_prob) / s.inclusion for s in row) for row in rows]
    assert abs(np.mean(weights) - 1) < 0.02


def test_a_model_with_pieces_over_words_gets_whole_texts():
    net = Lattices(Vocabulary(MODEL, 1.0))
    assert net.vocabulary.in_units
    text = ["▁the▁a\n▁b", "", "▁▁c"]
    units, counts = net.units(text)
    assert units.to_pylist() == ["▁the", "▁a", "\n", "▁b", "▁▁c"] and list(counts) == [4, 0, 1]
    net.vocabulary.in_units = False
    units, counts = net.units(text)
    assert units.to_pylist() == [text[0], text[2]] and list(counts) == [1, 0, 1]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    every = {s for s, _ in all_segmentations(model, net.vocabulary.log_p, "▁the▁a")}
    (row,) = sample_batch(net, ["the a"], np.array([3], np.uint64), 100)
    assert {tuple(s.pieces.tolist()) for s in row} == every


def test_a_short_text_gives_all_it_has(net):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    every = {s for s, _ in all_segmentations(model, net.vocabulary.log_p, "▁the")}
    (row,) = sample_batch(net, ["the"], np.array([3], np.uint64), 100)
    assert {tuple(s.pieces.tolist()) for s in row} == every and len(row) == len(every)
    assert sum(np.exp(s.log_prob) for s in row) == pytest.approx(1)
    assert all(a.value > b.value for a, b in zip(row, row[1:]))


def test_round_trip(spark, odd_documents, no_documents):
    encoded = sample_pieces(odd_documents, k=2).cache()
    rows = encoded.collect()
    assert len(rows) == odd_documents.count() and all(r["round_trip"] for r in rows)
    assert all(len({tuple(i) for i in r["ids"]}) == len(r["ids"]) for r in rows)
    texts = {r["doc_id"]: r["texts"] for r in decode_pieces(encoded).collect()}
    for r in odd_documents.filter("doc_id is not null").collect():
        assert set(texts[r["doc_id"]]) == {r["text"] or ""}
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    short = next(r for r in rows if r["doc_id"] == 5)
    assert {model.decode(i) for i in short["ids"]} == {"ÄÖ é 日本 𓀀"}
    assert sample_pieces(no_documents).count() == 0


def test_draws_do_not_depend_on_how_rows_are_dealt(documents):
    a = sample_pieces(documents.repartition(1)).collect()
    b = sample_pieces(documents.repartition(7)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
