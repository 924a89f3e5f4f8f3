"""Cuts that were taken out again: each test fails where the cut stands."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from rollbook.llm import pieces, toxicity


@pytest.fixture(scope="module")
def words():
    return pieces.Vocabulary(*pieces.read_model(pieces.MODEL))


def test_every_occurrence_has_its_own_draw(words):
    word, n = " considerably", 4000
    work = pieces.Segmenter(words, 0.1, 11)
    (ids,) = work.encode([(word * n)[1:]], [99])
    ways, rest = Counter(), ids.tolist()
    while rest:
        k = next(k for k in range(1, len(rest) + 1) if work.decode(rest[:k]) == word[1:])
        ways[tuple(rest[:k])] += 1
        rest = rest[k:]
    assert ways.total() == n and len(ways) > 20
    # as often unvaried as under draws that share nothing
    plain = pieces.Segmenter(words, 0.0, 11).segment([word], [0])[0]
    apart = sum(ids == plain for ids in work.segment([word] * n, range(n)))
    assert abs(ways[tuple(plain)] - apart) < 0.05 * n


@pytest.mark.parametrize("remember", [1, 300_000])
def test_paths_of_chunks_agree_with_the_heap(words, remember):
    texts = ["the same words and the same draws, 日本 ▁ é " * 40, "the same words and the same draws " * 40]
    work = pieces.Segmenter(words, 0.2, 7, remember)
    for _ in range(2):
        got = work.encode(texts, [5, 6])
        want = work.encode(texts, [5, 6], longest=0)
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_lexicons_and_votes_come_from_all_rows(docs, labels):
    """Rare toxic words are mined from all labelled texts, however few the classifier is fitted on."""
    rows = [(i, f"{'grumblefax' if i % 40 == 0 else 'idiot' if i % 10 == 0 else 'fine'} text number{i} of today") for i in range(800)]
    own = labels([(i, 1, int(i % 10 == 0)) for i, _ in rows])
    model = toxicity.train(docs(rows), own, most=120)
    assert "grumblefax" in model.weights or "grumbl*" in model.weights
    again = toxicity.rate(docs([*rows, (9000, "such a grumblefax here")]), own, most=120).collect()
    assert {r.doc_id: r.predicted for r in again}[9000] == 1


def test_the_label_model_counts_texts_without_a_label(docs, labels):
    rows = [(i, f"idiot text number{i}" if i % 4 == 0 else f"fine text number{i}") for i in range(400)]
    known = toxicity.labelled(docs(rows), labels([(i, 1, int(i % 4 == 0)) for i in range(200)]), "toxic", "doc_id", "text")
    found = {}
    for r in toxicity.vote_counts(docs([*rows, (1, rows[1][1]), (900, None), (901, "")]), known, [], "text").collect():
        found[r.given] = found.get(r.given, 0) + r.n
    assert sum(found.values()) == 400 and found[0] > 200 and found[1] + found[-1] == known.count()
