"""Periodic runs of words, found as maximal pairs of an LCP-interval tree.

A run of smallest period q is a place h whose text comes again q words later, for
as long as possible in both directions: (h, h + q) is a maximal pair, and the words
both have in common are the run less its first q words.  So the suffixes of a
document are sorted, and the tree of their common prefixes is walked from the
leaves up.  Each node has the sorted places of its suffixes and, for each place,
the class of the word to its left.  Where children meet at a node of l common
words, neighbouring places i < j of different children and different left classes
are a maximal pair; with a distance q = j - i, 2 q <= l, and l + q words it is a
run, as it stands.  Places between i and j would have brought a smaller period, so
each run comes up once, with its smallest period.

Nothing but places whose first 16 words come again in the document can be part of
a run of 24 words or more and three periods; the others leave the sorting as
soon as they are alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import WORD


def sorted_suffixes(words: np.ndarray, depth: int) -> list[np.ndarray]:
    """Groups of places with the same first ``depth`` words, each in the order of its suffixes.

    ``words`` ends every document with a number of its own, and no word number
    occurs in two documents.  Prefix doubling; groups of one are done with.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    first = np.append(True, words[order][1:] != words[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    slots = np.arange(n)
    places, starts = order, first
    length, groups = 1, None
    while True:
        # groups of two and more
        many = ~(starts & np.append(starts[1:], True))
        slots, places, starts = slots[many], places[many], starts[many]
        if length == depth:
            groups = slots[starts], slots
        if not len(slots):
            break
        key = np.stack([rank[places], rank[places + length]])
        by = np.lexsort(key[::-1])
        places, key = places[by], key[:, by]
        order[slots] = places
        starts = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
        rank[places] = np.maximum.accumulate(np.where(starts, slots, 0))
        length *= 2
    if groups is None or not len(groups[0]):
        return []
    heads, kept = groups
    return np.split(order[kept], np.searchsorted(kept, heads)[1:])


def common_prefixes(words: list[int], groups: list[np.ndarray], depth: int) -> dict[int, int]:
    """For each place but the first of a group: how many words it has in common with the place before it.

    Taken in the order of the text, where the number falls by one at most.
    """
    before = {}
    for group in groups:
        own = group.tolist()
        before.update(zip(own[1:], own, strict=False))
    out, last, common = {}, -2, depth
    for place in sorted(before):
        common = max(common - 1, depth) if place == last + 1 else depth
        other = before[place]
        while words[place + common] == words[other + common]:
            common += 1
        out[place] = common
        last = place
    return out


def runs_of_group(group: list[int], common: dict[int, int], words: list[int], least: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) whose first place is in a group of sorted suffixes.

    The walk up the tree: the stack holds children not yet joined with what
    comes to their right, as (places, words in common with the right).
    """
    found: list[tuple[int, int, int]] = []

    def meet(i: int, j: int, shared: int) -> None:
        period = j - i
        if 2 * period <= shared and shared + period >= least and words[i - 1] != words[j - 1]:
            found.append((i, shared + period, period))

    def joined(x: list[int], y: list[int], shared: int) -> list[int]:
        if len(x) < len(y):
            x, y = y, x
        for k, place in enumerate(y):
            at = bisect_left(x, place)
            if at and (not k or y[k - 1] < x[at - 1]):
                meet(x[at - 1], place, shared)
            if at < len(x) and (k + 1 == len(y) or y[k + 1] > x[at]):
                meet(place, x[at], shared)
        if len(y) > 8:
            x += y
            x.sort()
        else:
            for place in y:
                insort(x, place)
        return x

    stack: list[tuple[list[int], int]] = []
    here = [group[0]]
    for place in group[1:]:
        shared = common[place]
        while stack and stack[-1][1] > shared:
            left, level = stack.pop()
            here = joined(left, here, level)
        stack.append((here, shared))
        here = [place]
    while stack:
        left, level = stack.pop()
        here = joined(left, here, level)
    return found


class Finder:
    """Runs of the documents of a batch: at least ``least`` words and three periods."""

    def __init__(self, least: int) -> None:
        # a pair shares least - q words for a period q below a third of least, 2 q above it
        self.least, self.depth = least, 1
        while 2 * self.depth <= least - least // 3:
            self.depth *= 2

    def find(self, texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) by start, then period, for each list of words."""
        codes: dict[str, int] = {}
        parts, starts, n = [], [], 0
        for own in texts:
            parts.append(np.fromiter((codes.setdefault(w, len(codes)) for w in own), np.int64, len(own)))
            starts.append(n + 1)
            n += len(own) + 1
        # a number for each word of each document, and one before and after each document that no other place has
        many = len(codes)
        words = np.empty(n + 1, np.int64)
        words[0] = -1
        for d, (own, start) in enumerate(zip(parts, starts, strict=True)):
            words[start : start + len(own)] = own + d * many
            words[start + len(own)] = -2 - d
        groups = sorted_suffixes(words, self.depth)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not groups:
            return out
        plain = words.tolist()
        common = common_prefixes(plain, groups, self.depth)
        for group in groups:
            found = runs_of_group(group.tolist(), common, plain, self.least)
            if found:
                d = int(np.searchsorted(starts, found[0][0], "right")) - 1
                out[d] += [(i - starts[d], length, period) for i, length, period in found]
        for own in out:
            own.sort(key=lambda r: (r[0], r[2]))
        return out


def without_repeats(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words left when each run keeps its first period only."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    drop = np.cumsum(drop)[:-1]
    return [w for w, d in zip(words, drop.tolist(), strict=True) if not d]


def _slices(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Documents of at most about ``most`` bytes of text, or one longer one."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24) -> DataFrame:
    """One row per document: id, runs (array of start, length, period by start, then period), collapsed.

    Words stand between the six ASCII white-space characters and are numbered
    from 0.  A run is a stretch of words with a smallest period, at least
    ``least`` words and three periods long, that no neighbouring
    word extends.  ``collapsed`` has the words outside of what follows the first
    period of a run, joined by one blank.  NULL, empty and blank texts have no
    runs and an empty ``collapsed``.  Whole texts are searched, however long; a
    text needs memory in proportion to its words.  Repeated rows give equal
    results, NULL ids stay, an empty table gives no rows.  Columns other than
    the two named ones are not read.
    """
    if least < 3:
        raise ValueError("three periods are three words at least")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, finder = re.compile(WORD).findall, Finder(least)
        for batch in batches:
            for a, b in _slices(batch.column("text")):
                part = batch.slice(a, b - a)
                words = [cut(text or "") for text in part.column("text").to_pylist()]
                runs = finder.find(words)
                flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3).T.copy()
                ends = np.cumsum([0, *map(len, runs)])
                fields = pa.StructArray.from_arrays([pa.array(x) for x in flat], ["start", "length", "period"])
                left = [without_repeats(w, r) if r else w for w, r in zip(words, runs, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields),
                        "collapsed": pa.array([" ".join(w) for w in left], pa.string()),
                    }
                )

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)
