"""Join helpers: complete keys, NULL-safe lookups.

How skew is kept in check throughout the library:

* what is aggregated is aggregated before it is joined, so copies of a hot key
  are folded in the tasks that read them;
* a join whose big side stays unaggregated has a scan or a written table on the
  other side and nothing keyed after it, the shape in which adaptive execution
  splits an oversized partition;
* nothing is forced to be broadcast by its row count: small sides that are used
  more than once are written, so the planner knows their bytes and chooses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def all_set(cols: Sequence[str]) -> Column:
    """True where no listed column is NULL."""
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).isNotNull()
    return test


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct complete keys; copies are folded before the shuffle."""
    return df.where(all_set(keys)).select(*keys).distinct()


def null_safe_left(rows: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on keys where NULL equals NULL; ``lookup`` is unique on them."""
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}"))
    extra = [F.col(f"l.{c}") for c in lookup.columns if c not in on]
    return rows.alias("r").join(lookup.alias("l"), same, "left").select("r.*", *extra)
