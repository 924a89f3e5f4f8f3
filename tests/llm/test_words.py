"""Runs of words, ranked search and BPE against their plain meaning."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from checks.compare import connect, difference

from rollbook.llm import ball_search, oracles, queries, word_bpe, word_runs

from .conftest import SF


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_ranked_search"])
def test_queries_agree_with_their_statements(spark, name):
    assert difference(queries.registry()[name](spark, SF), connect(SF), oracles.statements()[name]) is None


# -- runs ----------------------------------------------------------------------


def plain_runs(words, least=24):
    """(start, length, period) by trying every period."""
    found = {}
    for p in range(1, len(words) // 3 + 1):
        same = [words[i] == words[i + p] for i in range(len(words) - p)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            elif not s and start is not None:
                if i - start + p >= max(least, 3 * p):
                    found.setdefault((start, i - start + p), p)
                start = None
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [3, 12, 24])
def test_runs_of_few_words(least):
    draw, finder = random.Random(least), word_runs.Finder(least)
    for _ in range(80):
        texts = []
        for _ in range(4):
            words, n = [], draw.choice([0, 1, 5, 40, 150])
            while len(words) < n:
                unit = [draw.choice("abc"[: draw.choice([1, 2, 3])]) for _ in range(draw.choice([1, 2, 3, 5, 9, 13]))]
                words += unit * draw.choice([1, 1, 2, 3, 5, 20])
                if draw.random() < 0.2:
                    words += words[-20:]
            texts.append(words)
        assert finder.find(texts) == [plain_runs(w, least) for w in texts]


def test_runs_of_long_texts():
    finder = word_runs.Finder(24)
    assert finder.find([["a"] * 100_000]) == [[(0, 100_000, 1)]]
    word = (["a"] * 30 + ["b"]) * 2000
    (found,) = finder.find([word])
    assert len(found) == 2001 and (0, len(word), 31) in found


def test_runs_of_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "x y " * 12), (4, "x y " * 12), (None, "z\x0b" * 24), (5, "y\xa0 " * 23)]
    got = {(r.doc_id, i): r for i, r in enumerate(word_runs.find_runs(docs(rows)).collect())}
    runs = {k: [tuple(x) for x in r.runs] for k, r in got.items()}
    assert [runs[k, i] for i, (k, _) in enumerate(rows)] == [[], [], [], [(0, 24, 2)], [(0, 24, 2)], [(0, 24, 1)], []]
    assert [r.collapsed for r in got.values()] == ["", "", "", "x y", "x y", "z", " ".join(["y\xa0"] * 23)]
    assert word_runs.find_runs(docs([])).count() == 0


# -- ranked search ---------------------------------------------------------------


def plain_ranking(docs, items, k=10):
    terms = lambda text: re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 25 + 75 * c.total() * n_docs // n_terms
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("sizes", [{}, {"query_block": 40, "rows": 50, "values": 200}])
def test_ranking_equals_all_scores(spark, docs, sizes):
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdé", k=draw.randrange(1, 4))) for _ in range(80)]
    text = lambda n: " ".join(draw.choices(vocabulary, k=n)).title()
    rows = [(i, text(draw.choice([1, 3, 20, 200]))) for i in range(300)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(400)]  # large groups of equal texts
    rows += [(2000, None), (2001, ""), (2002, "-- ,;"), (None, text(9)), (7, rows[7][1])]
    items = [(i, text(8)) for i in range(12)] + [(50, None), (51, "!"), (52, "unheard"), (53, "a a a b")]
    got = ball_search.search(docs(rows), asked(spark, items), **sizes).collect()
    assert sorted(tuple(r) for r in got) == plain_ranking(rows, items)


def test_ranking_of_empty_tables(spark, docs):
    items = asked(spark, [(1, "some words")])
    assert ball_search.search(docs([]), items).count() == 0
    assert ball_search.search(docs([(1, "some words")]), asked(spark, [])).count() == 0
    assert ball_search.search(docs([(1, None), (2, " ")]), items).count() == 0


def test_bounds_hold_and_prune():
    """No score exceeds the bound of a ball above it; far clusters are not scored."""
    draw, width = np.random.default_rng(4), 60
    dense = np.zeros((2000, width), np.int64)
    for c in range(20):
        own = draw.choice(width, 6, replace=False)
        dense[100 * c : 100 * c + 100, own] = draw.integers(900_000, 1_000_000, (100, 6))
    terms = [np.flatnonzero(row) for row in dense]
    block = ball_search.Block(
        np.arange(2000), np.append(0, np.cumsum([len(t) for t in terms])), np.concatenate(terms),
        np.concatenate([dense[i, t] for i, t in enumerate(terms)]), width, leaf=50,
    )
    own = np.flatnonzero(dense[150])
    weights = np.arange(1, len(own) + 1) * 1000
    query = np.zeros((width, 1))
    query[own, 0] = weights
    bounds = block.bounds(query, np.sqrt((query * query).sum(axis=0)))[:, 0]
    scores = dense[:, own] @ weights
    for ball, bound in enumerate(bounds):
        assert scores[block.order[block.low[ball] : block.high[ball]]].max() <= bound
    best: list[tuple[int, int]] = []
    scored = block.search(bounds, own, weights, best, 10)
    want = sorted(zip((-scores).tolist(), range(2000), strict=True))[:10]
    assert sorted((-s, -i) for s, i in best) == want
    assert scored < 1000


# -- BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return word_bpe.Vocabulary(word_bpe.MODEL)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe.MODEL)


def same(model, library, texts, **kw):
    work = word_bpe.Encoder(model, **kw)
    ends, ids = work.encode(texts)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == want
    assert work.decode(ends, ids).to_pylist() == [library.decode(w, skip_special_tokens=False) for w in want]


def test_ids_of_odd_texts(model, library):
    texts = ["Hello world's don't 12 3<|endoftext|>Foo", "", None, "  ", "ΑΣ ΣΑΣ İI <|STARTOFTEXT|> <|startoftext|>", "日本語テキスト"]
    texts += ["''s 'S \x1c\x1d x\x85y\xa0z", "e<|endoftext|>́", "é Å", "aaaa" * 5000, "ab" * 700, "<|endoftext|>" * 3]
    same(model, library, texts)
    draw = random.Random(1)
    kinds = [(32, 127), (0x80, 0x530), (0x300, 0x370), (0x530, 0xD800), (0xE000, 0x110000)]
    signs = lambda: chr(draw.randrange(*draw.choice(kinds))) if draw.random() < 0.6 else draw.choice([" ", "'s", "'LL", "the", "Ab"])
    same(model, library, ["".join(signs() for _ in range(draw.randrange(200))) for _ in range(300)])


def test_ids_of_every_code_point(model, library):
    texts = [" ".join(f"{chr(c)}a" for c in range(a, a + 256) if not 0xD800 <= c < 0xE000) for a in range(0, 0x110000, 256)]
    same(model, library, texts)


@pytest.mark.parametrize("remember", [1, 50, 300_000])
def test_forgetting_changes_nothing(spark, model, library, remember):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    work = word_bpe.Encoder(model, remember)
    for a in range(0, len(texts), 10):
        ends, ids = work.encode(texts[a : a + 10])
        want = library.encode_batch([t or "" for t in texts[a : a + 10]], add_special_tokens=False)
        assert [ids[x:y].tolist() for x, y in zip(ends, ends[1:], strict=False)] == [w.ids for w in want]


def test_heap_and_rows_of_ranks_agree(model):
    work, draw = word_bpe.Encoder(model), random.Random(2)
    words = ["".join(draw.choices("aeinrst'é9", k=draw.randrange(1, 20))) for _ in range(2000)]
    assert [*map(tuple, map(work.merged, words))] == work.merged_together(words, 48)


def test_query_of_ids(spark, library):
    got = {r.doc_id: r for r in queries.registry()["op13_word_bpe"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        own = got[r.doc_id]
        assert own.n_tokens == len(ids) and own.ids_sha256 == digest(" ".join(map(str, ids)))
        assert own.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


def test_ids_of_odd_rows(spark, docs):
    out = word_bpe.encode(docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a")]))
    assert [(r.doc_id, len(r.ids), r.decoded) for r in out.collect()] == [
        (1, 0, ""), (2, 0, ""), (3, 2, "a</w> b</w>"), (3, 2, "a</w> b</w>"), (None, 1, "a</w>")
    ]
    again = word_bpe.decode(out.withColumnRenamed("decoded", "was"))
    assert all(r.was == r.decoded for r in again.collect())
    assert word_bpe.encode(docs([])).count() == 0
