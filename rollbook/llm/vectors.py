"""Near-duplicate vectors by p-stable hashing, and exact top-k search without random access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.components import connected
from rollbook.llm.groups import dealt, map_groups


def usable(vector: str) -> Column:
    """Whether a vector is there, is not empty, and all its components are finite."""
    v = F.col(vector)
    wide = F.transform(v, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


# -- near-duplicates ---------------------------------------------------------


def _projections(dim: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([seed, dim])
    return draw.standard_normal((dim, tables * hashes)), draw.uniform(0, width, tables * hashes)


def _bucketed(tables: int, hashes: int, width: float, seed: int) -> object:
    """Rows (row, vector) to (row, keys, unit), one key per table made of its quantised projections."""
    mix = np.random.default_rng(seed + 1).integers(1, 2**62, tables * hashes, dtype=np.int64) * 2 + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy()
            for dim in np.unique(sizes):
                part = batch[sizes == dim]
                for a in range(0, len(part), 2048):
                    some = part.iloc[a : a + 2048]
                    x = np.stack(some["vector"].to_list()).astype(np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    along, shift = _projections(int(dim), tables, hashes, width, seed)
                    cells = np.floor((x @ along + shift) / width).astype(np.int64)
                    keys = (cells * mix).reshape(len(x), tables, hashes).sum(axis=2) ^ int(dim)
                    yield pd.DataFrame({"row": some["row"].to_numpy(), "keys": list(keys), "unit": list(x)})

    return run


def _linked(least: float) -> object:
    """Links of one block pair of one bucket, counted where the two vectors meet for the first time.

    Gives, for each vector with links, how many vectors they lead to, and a
    tie to a vector of its component: a spanning forest instead of all pairs.
    """

    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        own, x, y = group["_own"].to_numpy(), group["_x"].iloc[0], group["_y"].iloc[0]
        table, node, times = int(group["table"].iloc[0]), group["node"].to_numpy(), group["times"].to_numpy()
        unit, keys = np.stack(group["unit"].to_list()), np.stack(group["keys"].to_list())
        one, two = (np.arange(len(group)),) * 2 if x == y else (np.flatnonzero(own == x), np.flatnonzero(own == y))
        if not len(one) or not len(two):
            return None
        near = unit[one] @ unit[two].T >= least
        i, j = np.nonzero(np.triu(near, 1) if x == y else near)
        i, j = one[i], two[j]
        if table:
            met = np.empty(len(i), bool)
            for a in range(0, len(i), 4096):
                some = slice(a, a + 4096)
                met[some] = (keys[i[some], :table] == keys[j[some], :table]).any(axis=1)
            i, j = i[~met], j[~met]
        if not len(i):
            return None
        n = len(group)
        links = np.bincount(i, times[j], n) + np.bincount(j, times[i], n)
        # smallest neighbour within the block; those of a chain are tied one by one
        low = node.copy()
        np.minimum.at(low, i, node[j])
        np.minimum.at(low, j, node[i])
        joined = (low[i] == low[j]) | (low[i] == node[j]) | (low[j] == node[i])
        some = np.flatnonzero(links)
        rest_i, rest_j = node[i[~joined]], node[j[~joined]]
        return pd.DataFrame(
            {
                "a": np.concatenate([node[some], rest_i]),
                "b": np.concatenate([low[some], rest_j]),
                "links": np.concatenate([links[some], np.zeros(len(rest_i))]).astype(np.int64),
            }
        )

    return work


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    tables: int = 96,
    hashes: int = 10,
    width: float = 1.0,
    seed: int = 7,
    block: int = 512,
) -> DataFrame:
    """One row per row of ``rows``: id, n_links, component_id, kept.

    Unit vectors are hashed into ``tables`` tables by ``hashes`` quantised
    random projections each; those that share a bucket are compared exactly, in
    double precision.  Two vectors at cosine 0.95 share a bucket with a chance
    of 99.6 %, at 0.97 of more than 99.99 %.  Equal vectors are one node from
    the start and count as linked.  Vectors that are NULL, empty, zero, or hold
    NULL or non-finite components, and vectors of different lengths, link with
    nothing.  Repeated rows and repeated ids are vectors of their own; a NULL
    id is never smallest unless all are.  An empty table gives no rows.
    Columns other than the two named ones are not read.
    """
    numbered = stage(
        rows.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
        )
    )
    sound = numbered.filter(usable("vector")).filter(F.exists("vector", lambda x: x != 0))
    # equal vectors, hashed over their components with -0.0 taken as 0.0
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    hashed = sound.select("row", "id", F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(1), plain).alias("h2"))
    nodes = stage(hashed.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("times")))
    members = stage(hashed.join(nodes, ["h1", "h2"]).select("row", "id", "node", "times"))

    first = members.filter("row = node").select("row", "times")
    unique = sound.join(first, "row").select("row", "vector", "times")
    units = stage(
        unique.select("row", "vector").mapInPandas(
            _bucketed(tables, hashes, width, seed), "row long, keys array<long>, unit array<double>"
        )
    )
    placed = units.select(F.col("row").alias("node"), F.posexplode("keys").alias("table", "key"))
    buckets = stage(placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    held = stage(placed.join(buckets, ["table", "key"]))
    weights = first.select(F.col("row").alias("node"), "times")
    full = stage(units.withColumnRenamed("row", "node").join(weights, "node"))
    blocks = dealt(held, ["table", "key"], "node", "size", block).join(full, "node")
    found = stage(map_groups(blocks, ["table", "key", "_x", "_y"], _linked(least), "a long, b long, links long"))

    roots = stage(connected(found.select("a", "b")))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = stage(counts.join(roots, "node", "full"))
    own = members.join(known, "node", "left").select(
        "row",
        "id",
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    own = stage(own)
    lowest = stage(own.groupBy("root").agg(F.min("id").alias("component_id")))
    linked = own.join(lowest, "root", "left").select("id", "n_links", "component_id")
    rest = numbered.join(members.select("row"), "row", "left_anti")
    alone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


# -- exact search ------------------------------------------------------------

#: Scores below this are worked out in 64 bits, others in numbers of any length.
_BOUND = 1 << 62

#: Scores below this are whole in a double, whatever the order of the sum.
_WHOLE = 1 << 53

#: Bytes of candidates that one task searches, and of queries that it holds, if components took eight bytes.
_SEARCHED, _HELD = 32 << 20, 32 << 20


def _packed(scale: int) -> object:
    """Rows of one block to one row: numbers of the rows, ids, matrix of floor(scale * x), in the narrowest type that holds it."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((group["row"].to_numpy(), group["id"].to_numpy()))
        x = np.floor(scale * np.stack(group["vector"].to_list())[order].astype(np.float64))
        reach = float(np.abs(x).max(initial=0))
        kind = "int16" if reach < 1 << 15 else "int32" if reach < 1 << 31 else "float64"
        held = {name: [group[name].to_numpy()[order].tobytes()] for name in ("row", "id")}
        return pd.DataFrame(
            {"dim": [x.shape[1]], "block": [int(group["block"].iloc[0])], **held, "kind": [kind], "matrix": [x.astype(kind).tobytes()]}
        )

    return run


def _products(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole inner products of rows with a query."""
    reach = float(np.abs(x).max(initial=0)) * float(np.abs(query).max(initial=0)) * x.shape[1]
    if reach < _BOUND:
        return x.astype(np.int64) @ query.astype(np.int64)
    whole = [int(v) for v in query]
    return np.array([sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in x] + [None], object)[:-1]


class _Lists:
    """A block of rows as one sorted list per component."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, order, axis=0).astype(np.float64)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(n)[:, None], axis=0)
        self.values, self.reach = x.astype(np.float64), float(np.abs(x).max(initial=0))
        self._read: dict[int, tuple] = {}

    def read(self, depth: int) -> tuple:
        """What components of the rows are at most and at least, where lists have been read from their upper or lower end."""
        if depth not in self._read:
            n = len(self.x)
            top, bottom = self.place >= n - depth, self.place < depth
            most = np.where(top, self.values, self.sorted[n - depth]), np.where(bottom, self.values, self.sorted[depth - 1])
            least = np.where(top, self.values, self.sorted[0]), np.where(bottom, self.values, self.sorted[-1])
            self._read[depth] = most, least
        return self._read[depth]


def top_of_block(
    queries: np.ndarray,
    query_keys: np.ndarray,
    x: np.ndarray | _Lists,
    ids: np.ndarray,
    k: int,
    keys: np.ndarray | None = None,
    known: np.ndarray | None = None,
) -> list[tuple]:
    """The k best rows of one block for each query, from sorted lists read in order: (key of the query, id, score).

    ``keys`` (the ids, if left out) tell rows apart; a query does not find the
    row of its own key.  ``known`` is, for each query, a score that k rows
    elsewhere reach: rows below it are left out.

    Each component is a list sorted by value; a query reads it from the end
    that scores higher, all its lists to the same depth.  What has been read of
    a row counts as it is.  For its lower bound the unread components count
    with the value at the far end of their list, for its upper bound with the
    value at which reading stands.  Rows whose upper bound is below the k-th
    lower bound, or below what is known, are out, seen or not; when few are
    left, or the lists are at their end, the final scores of those left are
    worked out.  The queries of a block read in step, so the bounds of all are
    matrix products.
    """
    block = x if isinstance(x, _Lists) else _Lists(x)
    x, n = block.x, len(block.x)
    few = max(4 * k, 64)
    alive = (ids if keys is None else keys)[:, None] != query_keys[None, :]
    floor = np.full(len(queries), -np.inf) if known is None else known
    going = np.arange(len(queries))
    up, down = np.maximum(queries, 0).T.astype(np.float64), np.minimum(queries, 0).T.astype(np.float64)
    reach = block.reach * float(np.abs(queries).max(initial=0)) * x.shape[1]
    # room for rounding where scores leave the whole numbers of a double
    room = 1e-12 * reach
    depth = max(32, n // 4)
    while n > few and depth < n and len(going):
        most, least = block.read(depth)
        some = going if len(going) < len(queries) else slice(None)
        u, d = up[:, some], down[:, some]
        upper = most[0] @ u + most[1] @ d
        bar = floor[some]
        if np.isinf(bar).any():
            lower = least[0] @ u + least[1] @ d
            lower[~alive[:, some]] = -np.inf
            bar = np.maximum(bar, np.partition(lower, n - k, axis=0)[n - k])
        alive[:, some] &= upper >= bar - room
        going = going[alive[:, some].sum(axis=0) > few]
        depth *= 2
    whole = block.values @ queries.T.astype(np.float64) if reach < _WHOLE and alive.sum() > few * len(queries) else None
    out = []
    for c in np.flatnonzero(alive.any(axis=0)):
        left = np.flatnonzero(alive[:, c])
        if whole is not None:
            score = whole[left, c].astype(np.int64)
        elif reach < _WHOLE:
            score = (block.values[left] @ queries[c].astype(np.float64)).astype(np.int64)
        else:
            score = _products(x[left], queries[c])
        if len(left) > few:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            left, score = left[score >= cut], score[score >= cut]
        best = sorted(zip((-score).tolist(), ids[left].tolist(), strict=True))[:k]
        out += [(int(query_keys[c]), i, -below) for below, i in best]
    return out


class _Asked:
    """A block of queries that a task holds, and what it has found for them."""

    def __init__(self, kind: str, dim: int, matrix: bytes, row: bytes, id: bytes):
        self.matrix = np.frombuffer(matrix, kind).reshape(-1, dim)
        self.rows, ids = (np.frombuffer(m, np.int64) for m in (row, id))
        self.id_of = dict(zip(self.rows.tolist(), ids.tolist(), strict=True))
        self.best: dict[int, list] = {own: [] for own in self.rows.tolist()}
        self.known = np.full(len(self.rows), -np.inf)

    def search(self, lists: _Lists, rows: np.ndarray, ids: np.ndarray, k: int) -> None:
        news: dict[int, list] = {}
        for own, i, score in top_of_block(self.matrix.astype(np.float64), self.rows, lists, ids, k, rows, self.known):
            news.setdefault(own, []).append((-score, i))
        for c, own in enumerate(self.rows.tolist()):
            if own in news:
                self.best[own] = sorted(self.best[own] + news[own])[:k]
                last = -self.best[own][-1][0]
                if len(self.best[own]) == k and abs(last) < _BOUND:
                    # a double next to it, so that equal scores stay
                    self.known[c] = np.nextafter(float(last), -np.inf) if abs(last) >= _WHOLE else last

    def found(self) -> pd.DataFrame | None:
        if any(below <= -(1 << 63) for best in self.best.values() for below, _ in best[:1]):
            raise OverflowError("a score leaves 64 bits")
        # one that is too low counts only if it is among the best in the end
        low = -(1 << 63)
        told = [(own, self.id_of[own], i, max(-below, low), -below < low) for own, best in self.best.items() for below, i in best]
        return pd.DataFrame(told, columns=["query_row", "query_id", "vec_id", "score", "too_low"]) if told else None


def _searched(k: int) -> object:
    """Rows of cells, the queries of each length before its candidates, to the best of each cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[_Asked] = []
        at = None
        for batch in batches:
            for r in batch.itertuples():
                if (r.cell, r.dim) != at:
                    yield from (x for x in (a.found() for a in held) if x is not None)
                    held, at = [], (r.cell, r.dim)
                if not r.side:
                    held.append(_Asked(r.kind, r.dim, r.matrix, r.row, r.id))
                elif held:
                    lists = _Lists(np.frombuffer(r.matrix, r.kind).reshape(-1, r.dim).astype(np.float64))
                    rows, ids = (np.frombuffer(m, np.int64) for m in (r.row, r.id))
                    for asked in held:
                        asked.search(lists, rows, ids, k)
        yield from (x for x in (a.found() for a in held) if x is not None)

    return run


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    block: int = 2048,
    query_block: int = 128,
) -> DataFrame:
    """The k best rows for each query row: query_id, rank, vec_id, score.

    Components are taken as floor(scale * x), scores are whole inner products,
    ties go to the smaller id.  Vectors that are NULL or empty, or hold NULL or
    non-finite components, take no part; neither do NULL ids.  Components may be
    of any size: what 64 bits cannot hold is worked out in longer numbers, and
    only a score among the best that leaves 64 bits is an error.  A query meets
    vectors of its own length only.  A row is a row: those that repeat an id or a
    vector are all candidates, of one another too, and each asks for itself.
    With fewer than k candidates all are given; an empty table gives no rows.
    Columns other than the two named ones are read only by ``is_query``.
    """
    whole = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks")
    )
    whole = whole.filter(usable("vector") & F.col("id").isNotNull()).withColumn("dim", F.size("vector"))
    whole = stage(whole.withColumn("row", F.monotonically_increasing_id()))
    schema = "dim int, block int, row binary, id binary, kind string, matrix binary"
    asking = F.when(F.col("asks"), F.col("dim"))
    sums = whole.agg(F.count(F.lit(1)), F.sum("dim"), F.count(asking), F.sum(asking)).first()
    n, size, n_asks, asked = (x or 0 for x in sums)

    def packed(part: DataFrame, blocks: int) -> DataFrame:
        dealt_out = part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        return stage(map_groups(dealt_out, ["dim", "block"], _packed(scale), schema))

    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_asks // query_block))
    # every candidate meets every query of its length, in a grid of cells: a task has some of the candidates and of the
    # queries, so what is dealt out grows with the sides of the grid and not with its pairs
    wide = min(blocks, max(32 + blocks // 32, -(-8 * size // _SEARCHED)))
    high = min(query_blocks, max(1, -(-8 * asked // _HELD)))

    def in_cells(rows: DataFrame, side: int, x: Column, y: Column) -> DataFrame:
        one_axis = rows.withColumn("x", x)
        cells = one_axis.withColumn("cell", F.col("x") * high + y)
        return cells.select("cell", "dim", F.lit(side).alias("side"), "row", "id", "kind", "matrix")

    all_of = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = packed(whole, blocks).withColumn("y", all_of(high))
    candidates = in_cells(candidates, 1, F.col("block") % wide, F.col("y"))
    asks = packed(whole.filter("asks"), query_blocks).withColumn("x", all_of(wide))
    asks = in_cells(asks, 0, F.col("x"), F.col("block") % high)
    # by number, as tasks are not to be put together by their few bytes, and into many, so that few share one
    pieces = asks.unionByName(candidates).repartition(8 * wide * high, "cell").sortWithinPartitions("cell", "dim", "side")
    found = pieces.mapInPandas(_searched(k), "query_row long, query_id long, vec_id long, score long, too_low boolean")
    order = Window.partitionBy("query_row").orderBy("too_low", F.desc("score"), "vec_id")
    best = stage(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    fits = F.when(F.col("too_low"), F.raise_error(F.lit("a score leaves 64 bits"))).otherwise(F.col("score"))
    return best.select("query_id", "rank", "vec_id", fits.cast("long").alias("score"))
