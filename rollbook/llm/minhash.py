"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Sets of five-word shingles are signed with 128 min-hashes; bands of four make
the candidates.  Candidate pairs are compared one batch of the signature after
the other and dropped as soon as the posterior probability of the wanted
similarity falls below the chosen chance of a miss; what survives is verified
on the full sets.

Equal sets are one node from the start.  Each node is compared with a few hubs,
those of its buckets that it shares most buckets with, and joined to what it is
linked with; that is linear in the nodes and joins most of a large group of
copies.
Then all pairs of a bucket that are still in different components are compared
in blocks of bounded size, first by signature, to find the nodes that need
their full sets, then by set.  A block gives the links that join components and
no other pairs, so a large group never gives all its pairs, and no pair that
could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.components import connected
from rollbook.llm.groups import dealt, map_groups

#: Hashes of a signature, and how many of them make a band.
HASHES, BAND = 128, 4
#: Hashes that are compared at a time.
BATCH = 32
#: Words of a shingle.
WORDS = 5
#: Text that is worked on at a time, and shingles hashed at a time.
_SLICE, _ROWS = 1 << 20, 2048

_random = np.random.default_rng(20240131)
_CHAR = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _random.integers(1, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_BASE, _FINAL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CHAR[_SPACE] = 0


def _final(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _FINAL
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of each word; ``starts_at`` are the documents' first bytes and the end."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    heads = starts_at[:-1][starts_at[:-1] < starts_at[1:]]
    first[heads] = ~space[heads]
    at = np.flatnonzero(first)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    place = np.arange(len(data))
    place[at[0] :] -= np.repeat(at, np.diff(np.append(at, len(data))))
    place[space] = 0
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE, np.uint64))
    sums = np.add.reduceat(_CHAR[_LOWER[data]] * powers[place], at)
    return _final(sums), np.searchsorted(starts_at, at, "right") - 1


def shingle_sets(data: np.ndarray, starts_at: np.ndarray) -> list[np.ndarray]:
    """For each document, its distinct shingles as sorted 64-bit hashes; fewer than five words are one shingle."""
    words, doc = _word_hashes(data, starts_at)
    docs = len(starts_at) - 1
    cuts = np.searchsorted(doc, np.arange(docs + 1))
    rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        rolled += words[j : j + len(rolled)] * _MIX[j]
    rolled = _final(rolled)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            short = (words[a:b] * _MIX[: b - a]).sum(keepdims=True)
            out.append(_final(short + np.array([b - a], np.uint64) * _MIX[WORDS:]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 min-hashes of 16 bits, four to a number; each number is the key of a band."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _ROWS):
        np.minimum(low, (shingles[i : i + _ROWS, None] * _TIMES + _PLUS).min(axis=0), out=low)
    return (_final(low) >> np.uint64(48)).astype(np.uint16).view(np.int64)


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents with at most about 1 MB of text: first, end, bytes, where each starts."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _SLICE, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, ones, twos, signatures = [], [], [], []
        for _, _, data, starts_at in _slices(batch.column("text")):
            for s in shingle_sets(data, starts_at):
                sizes.append(len(s))
                mixed = _final(s ^ _MIX[0])
                ones.append(int(s.sum().view(np.int64)) if len(s) else 0)
                twos.append(int(mixed.sum().view(np.int64)) if len(s) else 0)
                signatures.append(signature(s) if len(s) else np.empty(0, np.int64))
        yield pa.RecordBatch.from_pydict(
            {
                "row": batch.column("row"),
                "id": batch.column("id"),
                "n": pa.array(sizes, pa.int64()),
                "h1": pa.array(ones, pa.int64()),
                "h2": pa.array(twos, pa.int64()),
                "sig": pa.array(signatures, pa.list_(pa.int64())),
            }
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s.tobytes() for _, _, data, at in _slices(batch.column("text")) for s in shingle_sets(data, at)]
        yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "set": pa.array(found, pa.binary())})


def least_matches(compared: int, similarity: float, miss: float) -> int:
    """Fewest matches among ``compared`` hashes with which the similarity is still reached with probability ``miss``.

    The posterior of the similarity under a flat prior is a beta distribution,
    whose tail is a binomial sum for whole numbers.
    """
    for m in range(compared + 1):
        tail = sum(comb(compared + 1, j) * similarity**j * (1 - similarity) ** (compared + 1 - j) for j in range(m + 1))
        if tail >= miss:
            return m
    return compared + 1


def _limits(similarity: float, miss: float) -> list[int]:
    return [least_matches(n, similarity, miss) for n in range(BATCH, HASHES + 1, BATCH)]


def _stack(signatures: pd.Series) -> np.ndarray:
    return np.stack(signatures.to_list()).view(np.uint16).reshape(len(signatures), HASHES)


def _pruned(limits: list[int]) -> object:
    """Pairs with both signatures, batch by batch, to those that may be similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            if not len(pairs):
                continue
            left, right, count = _stack(pairs["sig_a"]), _stack(pairs["sig_b"]), np.zeros(len(pairs), np.int32)
            alive = np.arange(len(pairs))
            for k, least in enumerate(limits):
                at = slice(k * BATCH, (k + 1) * BATCH)
                count[alive] += (left[alive, at] == right[alive, at]).sum(axis=1, dtype=np.int32)
                alive = alive[count[alive] >= least]
            yield pd.DataFrame({"a": pairs["a"].to_numpy()[alive], "b": pairs["b"].to_numpy()[alive]})

    return run


def _survivors(group: pd.DataFrame, limits: list[int], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block pair in different components that may be similar enough, the likeliest first.

    Only pairs that meet here for the first time, in the lowest band they share.
    """
    own, x, y, band = group["_own"].to_numpy(), group["_x"].iloc[0], group["_y"].iloc[0], int(group["band"].iloc[0])
    sig, root, n = _stack(group["sig"]), group["root"].to_numpy(), group["n"].to_numpy()
    if x == y:
        i, j = np.triu_indices(len(group), 1)
    else:
        i, j = (v.ravel() for v in np.meshgrid(np.flatnonzero(own == x), np.flatnonzero(own == y), indexing="ij"))
    near = (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]))
    i, j = i[near], j[near]
    count = np.zeros(len(i), np.int32)
    for k, least in enumerate(limits):
        at = slice(k * BATCH, (k + 1) * BATCH)
        count += (sig[i, at] == sig[j, at]).sum(axis=1, dtype=np.int32)
        alive = count >= least
        i, j, count = i[alive], j[alive], count[alive]
    if band and len(i):
        keys = np.stack(group["sig"].to_list())[:, :band]
        fresh = ~(keys[i] == keys[j]).any(axis=1)
        i, j, count = i[fresh], j[fresh], count[fresh]
    order = np.argsort(-count, kind="stable")
    return i[order], j[order]


def _active(limits: list[int], similarity: float) -> object:
    """Nodes of one block pair that have a surviving pair there."""

    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        i, j = _survivors(group, limits, similarity)
        some = np.unique(np.concatenate([i, j]))
        return group.iloc[some][["band", "key", "node", "root"]] if len(some) else None

    return work


def _joined(limits: list[int], percent: int) -> object:
    """Links of one block pair that join components, checked on the full sets."""

    def work(group: pd.DataFrame) -> pd.DataFrame | None:
        i, j = _survivors(group, limits, percent / 100)
        node, sets = group["node"].to_numpy(), [np.frombuffer(s, np.uint64) for s in group["set"]]
        root = group["root"].tolist()
        above = dict(zip(root, root, strict=True))

        def top(r: int) -> int:
            while above[r] != r:
                above[r] = r = above[above[r]]
            return r

        out = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            one, two = top(root[a]), top(root[b])
            if one != two and _linked(sets[a], sets[b], percent):
                above[one] = two
                out.append((node[a], node[b]))
        return pd.DataFrame(out, columns=["a", "b"]) if out else None

    return work


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _verified(percent: int) -> object:
    """Pairs with both full sets to those with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                keep.append(_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _mixed(rooted: DataFrame, *about: object) -> DataFrame:
    """Members (band, key, node, root) of the buckets that hold several components, with aggregates of their bucket."""
    rooted = stage(rooted)
    low, high = F.min("root").alias("_low"), F.max("root").alias("_high")
    buckets = stage(rooted.groupBy("band", "key").agg(low, high, *about).filter("_low != _high").drop("_low", "_high"))
    return stage(rooted.join(buckets, ["band", "key"]))


class _Links:
    """Links found so far, and the component of each node that has one."""

    def __init__(self, sets: DataFrame, percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.links: DataFrame | None = None
        self.roots = sets.sparkSession.createDataFrame([], "node long, root long")

    def verify(self, pairs: DataFrame) -> None:
        """Exact check of pairs (a, b) on the full sets."""
        one = self.sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
        two = self.sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
        joined = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b")
        self.add(joined.mapInArrow(_verified(self.percent), "a long, b long"))

    def add(self, found: DataFrame) -> None:
        """Links (a, b) that have been checked."""
        found = stage(found)
        self.links = found if self.links is None else self.links.unionAll(found)
        # stars stand for what was linked before
        stars = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        self.roots = stage(connected(stars.unionAll(found)))

    def rooted(self, rows: DataFrame) -> DataFrame:
        """Rows with a node, and the component it is in so far."""
        return rows.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    miss: float = 1e-4,
    hubs: int = 2,
    block: int = 256,
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, chosen; with ``carry`` the row itself as ``row``.

    Words are what stands between ASCII white space, A-Z lower-cased; a set is
    the distinct runs of five words, or all words of a shorter text.  Two
    documents are linked when 100 * intersection >= percent * union;
    component_id is the smallest id reachable.  NULL, empty and blank texts
    have no set and are alone.  ``kept`` says that the id is its component's;
    repeated rows are linked and kept alike, ``chosen`` is true for exactly one
    row of a component (of all rows without a set).  A NULL id is never
    smallest unless all are NULL (component_id is then NULL).  An empty table gives
    no rows.  Columns other than the two named ones are only carried.
    """
    spark = docs.sparkSession
    kept_columns = F.struct("*") if carry else F.struct(F.col(id_col), F.col(text_col))
    rows = stage(docs.select(kept_columns.alias("_row"), F.monotonically_increasing_id().alias("row")))
    text = F.coalesce(F.col("_row")[text_col], F.lit("")).alias("text")
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = stage(
        rows.select("row", F.col("_row")[id_col].alias("id"), text).mapInArrow(
            _sign, f"row long, id {id_type}, n long, h1 long, h2 long, sig array<long>"
        )
    )

    # equal sets are one node: the number of its first row
    nodes = stage(signed.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("row").alias("node")))
    first = F.when(F.col("row") == F.col("node"), F.col("sig"))
    members = stage(
        signed.filter("n > 0").join(nodes, ["n", "h1", "h2"]).select("row", "id", "n", "node", first.alias("sig"))
    )
    signatures = members.filter("row = node").select("node", "n", "sig")

    banded = signatures.select("node", F.posexplode("sig").alias("band", "key"))
    picks = [F.min_by("node", F.xxhash64(F.lit(turn), "node")) for turn in range(hubs)]
    buckets = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), *[p.alias(f"hub{i}") for i, p in enumerate(picks)])
    buckets = stage(buckets.filter("size > 1").drop("size"))
    held = stage(banded.join(buckets, ["band", "key"]))
    limits = _limits(percent / 100, miss)

    # full sets of all nodes that share a bucket with another
    wanted = held.select("node").distinct()
    texts = rows.select(F.col("row").alias("node"), text)
    links = _Links(stage(texts.join(wanted, "node", "left_semi").mapInArrow(_sets, "node long, set binary")), percent)

    # each node with the hubs it shares most buckets with
    turns = F.posexplode(F.array(*[f"hub{i}" for i in range(hubs)])).alias("turn", "a")
    spokes = held.select("node", turns).filter("node != a").groupBy("node", "turn", "a").agg(F.count(F.lit(1)).alias("n"))
    best = spokes.groupBy("node", "turn").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    pairs = stage(best.select("a", F.col("node").alias("b")).distinct())
    one = signatures.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))
    two = signatures.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    likely = pairs.join(two, "b").join(one, "a").filter(near).select("a", "b", "sig_a", "sig_b")
    links.verify(stage(likely.mapInPandas(_pruned(limits), "a long, b long")))
    held = held.select("band", "key", "node")

    # buckets that still hold several components, in blocks: by signature, then by set
    size = F.count(F.lit(1)).alias("size")
    keys = ["band", "key", "_x", "_y"]
    mixed = _mixed(links.rooted(held), size).join(signatures, "node")
    active = map_groups(
        dealt(mixed, ["band", "key"], "node", "size", block),
        keys,
        _active(limits, percent / 100),
        "band int, key long, node long, root long",
    )
    active = stage(active.distinct())
    sizes = stage(active.groupBy("band", "key").agg(size))
    whole = active.join(sizes, ["band", "key"]).join(signatures.join(links.sets, "node"), "node")
    links.add(map_groups(dealt(whole, ["band", "key"], "node", "size", block), keys, _joined(limits, percent), "a long, b long"))

    # back to rows
    own = members.join(links.roots, "node", "left").select("row", "id", "n", F.coalesce("root", "node").alias("root"))
    alone = signed.filter("n = 0").select("row", "id", "n", F.lit(None).cast("long").alias("root"))
    own = stage(own.unionAll(alone))
    tops = stage(
        own.filter("root is not null")
        .groupBy("root")
        .agg(F.min("id").alias("component_id"), F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("top"))
        .select("root", "component_id", F.col("top.row").alias("top"))
    )
    single = F.col("root").isNull()
    result = own.join(tops, "root", "left").select(
        "row",
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(single, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(single, F.col("id").isNotNull()).otherwise(F.col("id") == F.col("component_id")), F.lit(False)).alias("kept"),
        (single | (F.col("row") == F.col("top"))).alias("chosen"),
    )
    if not carry:
        return result.drop("row")
    return result.join(rows, "row").drop("row").withColumnRenamed("_row", "row")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The columns of ``docs`` for one document of each component."""
    return near_duplicates(docs, id_col, text_col, carry=True, **options).filter("chosen").select("row.*")
