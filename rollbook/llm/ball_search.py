"""Ranked lexical search: exact inner products through a sparse ball tree.

A document is a sparse vector of whole numbers, one for each term, made of the
term's count and the document's length; a query weighs its terms, and a score is
the inner product.  Documents are cut into blocks, each a tree of balls (centroid
and radius) over the terms that the queries can meet: other terms change no score
and would only widen the balls.  The Cauchy-Schwarz bound of a ball, rounded up by
more than its arithmetic can lose, is at least the score of all its documents.  A
query takes balls best first and ends when the best bound left is below its k-th
score; leaves are scored in whole numbers.  A task carries its best scores from
block to block, so later blocks are pruned by what earlier ones gave.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.staging import stage

#: What stands between terms is ASCII other than letters and digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_EPS = 2.0**-52


def terms_of(text: str | None) -> list[str]:
    """Terms of a text in order; only A-Z are lower-cased."""
    return re.findall(TERM, (text or "").translate(_LOWER))


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Documents of one block as a ball tree.

    ``rows`` are (ids, term counts before each document, terms, values); after
    building, the documents of a ball stand next to one another.
    """

    def __init__(self, ids: np.ndarray, cuts: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int, leaf: int = 128) -> None:
        self.ids, self.cuts, self.terms, self.values, self.width = ids, cuts, terms, values, width
        self.real = values.astype(np.float64)
        self.norms = self._sums(self.real * self.real)
        self.order = np.arange(len(ids))
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        self.centers: list[np.ndarray] = []
        self.radii: list[float] = []
        self._grow(0, len(ids), leaf)
        self.center = np.array(self.centers).reshape(len(self.centers), width)
        self.radius = np.array(self.radii)
        self.leaves: dict[int, tuple[np.ndarray, ...]] = {}

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of values by document."""
        total = np.append(0.0, np.cumsum(values)) if len(values) == 0 else np.append(np.add.reduceat(values, np.minimum(self.cuts[:-1], len(values) - 1)), 0.0)
        return np.where(np.diff(self.cuts) > 0, total[: len(self.ids)], 0.0)

    def _picked(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the values of some documents, and which of the documents each belongs to."""
        sizes = self.cuts[docs + 1] - self.cuts[docs]
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(docs)), sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.cuts[docs] - ends + sizes, sizes), owner

    def _grow(self, low: int, high: int, leaf: int) -> int:
        """The ball of the documents at ``order[low:high]`` and all below it; splits are halves, so the depth is bounded."""
        docs = self.order[low:high]
        at, owner = self._picked(docs)
        terms, real = self.terms[at], self.real[at]
        dot = lambda v: np.bincount(owner, real * v[terms], len(docs))
        center = np.bincount(terms, real, self.width) / len(docs)
        size = float(center @ center)
        apart = self.norms[docs] - 2 * dot(center) + size
        # what rounding can have cost: a few units in the last place for each addend
        slack = 8 * (self.width + 8) * _EPS * (float(self.norms[docs].max()) + size)
        me = len(self.radii)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.centers.append(center)
        self.radii.append(math.sqrt(max(0.0, float(apart.max())) + slack))
        if len(docs) > leaf and self.radii[me] > 2 * math.sqrt(slack):
            # towards one of two documents that are far from one another, by halves
            one = docs[int(apart.argmax())]
            pole = np.zeros(self.width)
            own = slice(self.cuts[one], self.cuts[one + 1])
            pole[self.terms[own]] = self.real[own]
            far = docs[int((self.norms[docs] - 2 * dot(pole)).argmax())]
            other = slice(self.cuts[far], self.cuts[far + 1])
            np.subtract.at(pole, self.terms[other], self.real[other])
            by = np.argsort(dot(pole), kind="stable")
            self.order[low:high] = docs[by]
            half = (low + high) // 2
            self.children[me] = (self._grow(low, half, leaf), self._grow(half, high, leaf))
        return me

    def bounds(self, queries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each ball and query (columns) a number that no score in the ball exceeds."""
        along = self.center @ queries
        reach = self.radius[:, None] * lengths
        return (along + reach) * (1 + 4 * (self.width + 8) * _EPS) + 1

    def scores(self, ball: int, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores, in whole numbers, of the documents of a leaf."""
        if ball not in self.leaves:
            docs = self.order[self.low[ball] : self.high[ball]]
            at, owner = self._picked(docs)
            by = np.argsort(self.terms[at], kind="stable")
            held = self.terms[at][by]
            self.leaves[ball] = self.ids[docs], owner[by], self.values[at][by], np.searchsorted(held, np.arange(self.width + 1))
        ids, owner, values, cuts = self.leaves[ball]
        starts, sizes = cuts[terms], cuts[terms + 1] - cuts[terms]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        total = np.zeros(len(ids), np.int64)
        np.add.at(total, owner[at], values[at] * np.repeat(weights, sizes))
        return ids, total

    def search(self, bounds: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Bring a heap of (score, -id) up to date, balls best first; returns how many documents were scored."""
        agenda, scored = [(-bounds[0], 0)], 0
        while agenda:
            bound, ball = heapq.heappop(agenda)
            # equal scores can still win by a smaller id
            if len(best) == k and -bound < best[0][0]:
                break
            if self.children[ball] is not None:
                for child in self.children[ball]:
                    heapq.heappush(agenda, (-bounds[child], child))
                continue
            ids, total = self.scores(ball, terms, weights)
            scored += len(ids)
            some = np.flatnonzero(total >= max(1, best[0][0] if len(best) == k else 1))
            if len(some) > k:
                # the k best of the leaf, ties by id
                some = some[np.lexsort((ids[some], -total[some]))[:k]]
            for score, own in zip(total[some].tolist(), ids[some].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (score, -own))
                elif (score, -own) > best[0]:
                    heapq.heapreplace(best, (score, -own))
        return scored


def _counted(terms: list[str]) -> object:
    """Rows (id, text) to (id, n, terms, counts), the terms as their places in the given list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                found = [terms_of(text) for text in part.column("text").to_pylist()]
                held = [Counter(filter(place.__contains__, own)) for own in found]
                ends = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
                flat = np.fromiter((place[t] for c in held for t in c), np.int32)
                counts = np.fromiter(chain.from_iterable(c.values() for c in held), np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "n": pa.array([len(own) for own in found], pa.int64()),
                        "terms": pa.ListArray.from_arrays(ends, pa.array(flat)),
                        "counts": pa.ListArray.from_arrays(ends, pa.array(counts)),
                    }
                )

    return run


def _blocks(batches: Iterator[pa.RecordBatch], rows: int, values: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Documents with terms in bounded blocks: ids, lengths, cuts, terms, counts."""
    for batch in batches:
        sizes = np.diff(batch.column("terms").offsets.to_numpy())
        total, a = np.cumsum(sizes), 0
        while a < len(batch):
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + values, "right"))
            b = min(max(a + 1, b), a + rows)
            part = batch.slice(a, b - a)
            yield (
                part.column("id").to_numpy(),
                part.column("n").to_numpy(),
                np.append(0, np.cumsum(sizes[a:b])),
                part.column("terms").flatten().to_numpy(),
                part.column("counts").flatten().to_numpy(),
            )
            a = b


def _searched(asks: list[tuple[object, np.ndarray, np.ndarray]], width: int, n_docs: int, n_terms: int, k: int, rows: int, values: int) -> object:
    """Blocks of documents to the k best (query, id, score) of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = np.zeros((width, len(asks)))
        for q, (_, terms, weights) in enumerate(asks):
            queries[terms, q] = weights
        lengths = np.sqrt((queries * queries).sum(axis=0)) * (1 + 4 * (width + 8) * _EPS)
        best: list[list[tuple[int, int]]] = [[] for _ in asks]
        for ids, n, cuts, terms, counts in _blocks(batches, rows, values):
            m = 25 + (75 * n * n_docs) // n_terms
            value = (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, np.diff(cuts)))
            block = Block(ids, cuts, terms, value, width)
            bounds = block.bounds(queries, lengths)
            for q, (_, own, weights) in enumerate(asks):
                block.search(bounds[:, q], own, weights, best[q], k)
        hits = [(asks[q][0], -own, score) for q, heap in enumerate(best) for score, own in heap]
        columns = [list(c) for c in zip(*hits, strict=True)] or [[], [], []]
        yield pa.RecordBatch.from_pydict(
            {"query": pa.array(columns[0], pa.int64()), "id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.int64())}
        )

    return run


def _in_blocks(queries: DataFrame, query_col: str, text_col: str, most: int) -> Iterator[list[tuple[object, str]]]:
    """Queries with a text, read one after the other, in lists of bounded length of text."""
    held, size = [], 0
    for row in queries.select(query_col, text_col).filter(F.col(text_col).isNotNull()).toLocalIterator():
        if held and size + len(row[1]) > most:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += len(row[1])
    if held:
        yield held


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text_col: str = "text",
    query_block: int = 1 << 18,
    rows: int = 4096,
    values: int = 1 << 20,
) -> DataFrame:
    """The k best documents of each query with a score above 0: query, rank, id, score.

    Equal scores go by ascending id.  A query without terms, or with a NULL or
    empty text, has no rows; documents without terms are never found and do not
    count among the documents.  Rows with a NULL id take no part as queries, and
    as documents count but are not found; rows that repeat an id are rows of
    their own.  Whole texts are read, however long.  Queries are worked on in
    blocks of about ``query_block`` characters, which bounds what the driver and
    each task hold of them; each block reads the documents once.  Empty tables
    give no rows.  Columns other than the named ones are not read.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "query long, id long, score long")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = queries.filter(F.col(query_col).isNotNull()).withColumn(query_col, F.col(query_col).cast("long"))
    for block in _in_blocks(asked, query_col, query_text_col, query_block):
        wanted = [(q, Counter(terms_of(text))) for q, text in block]
        wanted = [(q, c) for q, c in wanted if c]
        terms = sorted(set(chain.from_iterable(c for _, c in wanted)))
        if not terms:
            continue
        counted = stage(given.mapInArrow(_counted(terms), "id long, n long, terms array<int>, counts array<long>"))
        n_docs, n_terms = counted.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        # one row for each term of the block
        df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = [weight(n_docs, df.get(i, 0)) for i in range(len(terms))]
        place = {t: i for i, t in enumerate(terms)}
        asks = []
        for q, c in wanted:
            own = np.array([place[t] for t in c])
            asks.append((q, own, np.array([weights[place[t]] * times for t, times in c.items()], np.int64)))
        held = counted.filter("id IS NOT NULL AND size(terms) > 0")
        found = held.mapInArrow(_searched(asks, len(terms), n_docs, n_terms, k, rows, values), "query long, id long, score long")
        out = out.unionByName(stage(found))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = out.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_col), "rank", F.col("id").alias(id_col), "score")
