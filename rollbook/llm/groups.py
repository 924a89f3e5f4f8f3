"""Bounded groups worked on one after the other within sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_groups(
    rows: DataFrame, keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str
) -> DataFrame:
    """``work`` on each group of ``keys``; unlike one call per group through Spark, small groups cost little.

    A task holds one Arrow batch and the group that runs over its end, so the
    caller bounds the groups.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            cuts = _cuts(batch, keys)
            found = [work(batch.iloc[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            rest = batch.iloc[cuts[-1] :]
            found = [x for x in found if x is not None and len(x)]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and len(rest):
            out = work(rest)
            if out is not None and len(out):
                yield out

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _cuts(batch: pd.DataFrame, keys: list[str]) -> list[int]:
    """Where groups start; the last one may go on in the next batch."""
    values = [batch[k].to_numpy() for k in keys]
    new = np.zeros(len(batch), bool)
    new[0] = True
    for v in values:
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new).tolist()


def dealt(rows: DataFrame, keys: Sequence[str], item: str, size: str, block: int) -> DataFrame:
    """Rows of groups too large for one task, dealt so that any two of a group meet in one block pair.

    Adds ``_x`` <= ``_y``, the two blocks a row is sent for, and ``_own``, its
    own block; ``size`` holds the rows of the group.  Pairs of one block are
    compared where ``_x = _y``, pairs of two blocks where they differ.
    """
    parts = F.ceil(F.col(size) / F.lit(block)).cast("int")
    out = rows.withColumn("_own", F.pmod(F.xxhash64(item), parts.cast("long")).cast("int"))
    out = out.withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return out.withColumn("_x", F.least("_own", "_other")).withColumn("_y", F.greatest("_own", "_other")).drop("_other")
