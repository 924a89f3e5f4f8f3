"""Near-duplicate texts and vectors, exact search, components."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rollbook.llm import minhash, queries, vectors
from rollbook.llm.common import table
from rollbook.llm.components import connected
from tests.llm import brute
from tests.llm.conftest import SF
from pyspark.sql import functions as F


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 71), (71, 72), (72, 70), (3, 3)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = sorted({i for e in links for i in e if e[0] != e[1]})
    assert got == brute.components(ids, [e for e in links if e[0] != e[1]])
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def _corpus() -> list[tuple[int, str | None]]:
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    base = [[word() for _ in range(draw.choice((60, 120, 200)))] for _ in range(30)]
    out: list[tuple[int, str | None]] = []
    for words in base:
        for share in (0.0, 0.01, 0.02, 0.03, 0.05):
            out.append((len(out) * 3 + 1, " ".join(w if draw.random() > share else word() for w in words)))
    hub = [word() for _ in range(150)]
    for _ in range(60):  # a large group of near copies
        copy = list(hub)
        copy[draw.randrange(150)] = word()
        copy[draw.randrange(150)] = word()
        out.append((len(out) * 3 + 1, " ".join(copy)))
    out += [(90001 + i, "The SAME text, again and\tagain and again") for i in range(40)]
    out += [(90100, "the same text, again\nand again and again"), (90101, "one two"), (90102, "ONE  two "), (90103, "two one")]
    out += [(90200, ""), (90201, None), (90202, " \n\t"), (90203, ""), (90204, "Ä b c d e"), (90205, "ä b c d e")]
    out += [(90300, "long " + " ".join(f"w{i}" for i in range(30000))), (90301, " ".join(f"w{i}" for i in range(30000)))]
    return out


def test_near_duplicates_equal_brute_force(docs):
    rows = _corpus()
    want = brute.near_classes(dict(rows))
    got = minhash.near_duplicates(docs(rows), block=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_near_duplicates_with_repeated_rows_and_missing_ids(docs):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y"), (None, "x y")]
    rows += [(9, None), (9, None)]
    given = docs(rows)
    got = sorted(
        ((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_duplicates(given).collect())
    )
    assert got == sorted(
        [(5, 3, 2, False)] * 2 + [(2, 3, 2, True), (0, 3, 2, False)] + [(0, 1, 0, False)] * 2 + [(9, 0, 9, True)] * 2
    )
    kept = minhash.one_of_each(given)
    assert kept.columns == given.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 9, 9]
    assert minhash.near_duplicates(docs([])).count() == 0


def test_least_matches_is_the_posterior_bound():
    draw = np.random.default_rng(1)
    for n in (32, 64, 128):
        least = minhash.least_matches(n, 0.75, 1e-2)
        for m in (least - 1, least):
            tail = (draw.beta(m + 1, n - m + 1, 400_000) >= 0.75).mean()
            assert (tail >= 1e-2) == (m >= least)


def _vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, "x", "x", "x") for i, v in rows], "vec_id long, embedding array<float>, node string, score string, keys string"
    )


def _vector_rows() -> list[tuple]:
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        centre = draw.standard_normal(32)
        rows += [centre + 0.15 * draw.standard_normal(32) for _ in range(6)]
    rows += [rows[0]] * 30 + [rows[0] * 2.0]
    # floats, as the table holds them
    return [(i * 5, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


ODD = [(9001, None), (9002, []), (9003, [0.0] * 32), (9004, [1.0, float("nan")] * 16), (9005, [None] * 32), (9006, [1.0, 2.0])]


def test_near_vectors_equal_brute_force(spark):
    rows = _vector_rows()
    x = np.array([v for _, v in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [i for i, _ in rows]
    root = brute.components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near)), strict=True)])
    want = {i: (int(near[k].sum()), root[i]) for k, i in enumerate(ids)} | {i: (0, i) for i, _ in ODD}
    got = vectors.near_vectors(_vectors(spark, rows + ODD), block=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.near_vectors(_vectors(spark, [])).count() == 0
    odd = vectors.near_vectors(_vectors(spark, [(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0])])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in odd) == [(0, 2, 4, False)] + [(4, 2, 4, True)] * 2


def _best(rows, k):
    ids = np.array([i for i, _ in rows])
    z = np.floor(256 * np.array([v for _, v in rows], dtype=np.float64)).astype(np.int64)
    out = set()
    for a in np.flatnonzero(ids % 50 == 0):
        s = z @ z[a]
        order = [b for b in np.lexsort((ids, -s)) if b != a][:k]
        out |= {(int(ids[a]), r + 1, int(ids[b]), int(s[b])) for r, b in enumerate(order)}
    return out


def test_top_k_equals_brute_force(spark):
    rows = _vector_rows()
    asks = F.col("vec_id") % 50 == 0
    found = vectors.top_k(_vectors(spark, rows + ODD[:5] + [(None, [1.0] * 32)]), asks, block=64, query_block=4).collect()
    assert {tuple(r) for r in found} == _best(rows, 5) and len(found) == len(_best(rows, 5))
    few = [(0, [1.0, -1.0]), (50, [0.0, 0.0]), (7, [1.0, -1.0])]
    assert {tuple(r) for r in vectors.top_k(_vectors(spark, few), asks).collect()} == _best(few, 5)
    assert vectors.top_k(_vectors(spark, []), asks).count() == 0


@pytest.mark.parametrize("n,dim", [(1, 3), (5, 8), (700, 16), (3000, 4)])
def test_sorted_lists_give_the_exact_best(n, dim):
    draw = np.random.default_rng(n)
    x = draw.integers(-9, 10, (n, dim))
    q = draw.integers(-9, 10, (6, dim))
    q[0] = 0
    ids = np.arange(n) * 2
    got = vectors.top_of_block(q, np.array([-1, 0, 2, 4, 6, 8]), x, ids, 5)
    for query, own in zip(q, [-1, 0, 2, 4, 6, 8], strict=True):
        s = x @ query
        want = [(own, int(ids[b]), int(s[b])) for b in np.lexsort((ids, -s)) if ids[b] != own][:5]
        assert [g for g in got if g[0] == own] == want


def test_pair_queries_on_tables(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = queries.op4_near_duplicates(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near_classes(texts)
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert {tuple(r) for r in queries.op7_top_k(spark, SF).collect()} == _best(rows, 5)


def test_top_k_of_large_components_and_repeated_ids(spark):
    """No row is left out for its size; rows that share an id are rows of their own."""
    draw = np.random.default_rng(8)
    rows = [(i, [float(np.float32(v)) for v in draw.standard_normal(4) * 10.0 ** draw.integers(0, 7)]) for i in range(0, 400, 10)]
    rows += [(50, [400000.0, 1.0, 0.0, -3.0]), (50, [1.0, 1.0, 0.0, -3.0]), (1, [300000.0, 1.0, 5.0, 0.0]), (1, [300000.0, 1.0, 5.0, 0.0])]
    asks = F.col("vec_id") % 50 == 0
    whole = [(i, [int(np.floor(256 * v)) for v in vector]) for i, vector in rows]
    want = []
    for a, (own, q) in enumerate(whole):
        if own % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c, strict=True)), i) for b, (i, c) in enumerate(whole) if b != a)[:5]
            want += [(own, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert max(abs(w[3]) for w in want) > 1 << 53
    got = vectors.top_k(_vectors(spark, rows), asks, block=16, query_block=4).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    beyond = [(0, [1e18, 1.0]), (2, [1e18, 1.0]), (3, [-1e18, 1.0])]
    with pytest.raises(Exception, match="64 bits"):
        vectors.top_k(_vectors(spark, beyond), asks).collect()
    with pytest.raises(Exception, match="64 bits"):
        vectors.top_k(_vectors(spark, [beyond[0], beyond[2]]), asks).collect()
    fine = [(0, [1e18, 1.0]), *[(i, [0.0, float(i)]) for i in range(1, 8)], (9, [-1e18, 1.0])]
    assert vectors.top_k(_vectors(spark, fine), asks).count() == 5


def test_top_k_sends_queries_to_cells_and_joins_nothing(spark, monkeypatch):
    """Blocks of queries go to a grid of cells; they were copied for every block of candidates and broadcast."""
    rows = _vector_rows()
    rows += [(10_000 + i, [*v[:16]]) for i, v in rows if v is not None and len(v) >= 16]
    asks = F.col("vec_id") % 50 == 0
    plans, stage = [], vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda df: plans.append(df._jdf.queryExecution().toString()) or stage(df))
    want = _best_by_length(rows, 5)
    for searched, held in ((vectors._SEARCHED, vectors._HELD), (1 << 14, 1 << 10)):
        monkeypatch.setattr(vectors, "_SEARCHED", searched)
        monkeypatch.setattr(vectors, "_HELD", held)
        got = vectors.top_k(_vectors(spark, rows), asks, block=16, query_block=2).collect()
        assert sorted(tuple(r) for r in got) == want
    assert len(plans) == 8 and not any("Join" in p for p in plans)


def _best_by_length(rows, k):
    """``_best`` among the vectors of each length."""
    by = {}
    for i, v in rows:
        by.setdefault(len(v), []).append((i, v))
    return sorted(x for some in by.values() for x in _best(some, k))


def test_what_is_known_leaves_out_only_worse_rows():
    draw = np.random.default_rng(4)
    x, q, ids, own = draw.integers(-9, 10, (900, 6)), draw.integers(-9, 10, (7, 6)), np.arange(900), np.full(7, -1) - np.arange(7)
    scores = x @ q.T
    known = np.partition(scores, 895, axis=0)[895].astype(float)
    whole = vectors.top_of_block(q, own, x, ids, 5)
    assert vectors.top_of_block(q, own, x, ids, 5, known=known) == whole
    assert vectors.top_of_block(q, own, x, ids, 5, known=scores.max(axis=0) + 1000.0) == []
