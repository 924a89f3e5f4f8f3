"""Exact decimal means.

A mean decides a tier on its *unrounded* value and is shown rounded half away
from zero.  The built-in decimal average works in double and keeps six digits,
so both decisions can go wrong on large groups.  Here a mean is carried as two
integers, the sum of scaled units and the count.  They merge by addition, so
partial aggregation, pre-aggregation below a join and incremental totals all
give the same answer whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM, COUNT = "_sum_units", "_n"


def units(col: Column | str, scale: int = 2) -> Column:
    """A number as a whole number of units, rounded to ``scale`` fraction digits first."""
    col = F.col(col) if isinstance(col, str) else col
    return (col.cast(f"decimal(18,{scale})") * F.lit(10**scale)).cast("bigint")


def from_units(col: Column, precision: int = 5, scale: int = 2) -> Column:
    step = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale + 1},{scale})")
    return (col.cast("decimal(20,0)") * step).cast(f"decimal({precision},{scale})")


def mean_parts(score: str, scale: int = 2) -> list[Column]:
    """Aggregates that start a mean from raw values."""
    return [F.sum(units(score, scale)).alias(SUM), F.count(score).alias(COUNT)]


def merge_parts() -> list[Column]:
    """Aggregates that merge means already carried as (sum, count)."""
    return [F.sum(SUM).alias(SUM), F.coalesce(F.sum(COUNT), F.lit(0)).alias(COUNT)]


def half_up_ratio(num: Column, den: Column) -> Column:
    """``round(num / den)``, half away from zero, in whole numbers; den > 0."""
    return F.call_function("div", num * 2 + F.signum(num).cast("bigint") * den, den * 2)


def mean_units(total: Column | None = None, count: Column | None = None) -> Column:
    """Rounded mean in units; NULL where no value was counted."""
    total = F.col(SUM) if total is None else total
    count = F.col(COUNT) if count is None else count
    return F.when(count > 0, half_up_ratio(total, count))


def band(
    bands: Iterable[tuple[int, str]],
    otherwise: str,
    missing: str | None = None,
    scale: int = 2,
) -> Column:
    """Label of the first band whose floor the unrounded mean reaches.

    ``missing`` is the label of a group without any value; without it such a
    group takes ``otherwise``.
    """
    label = F.when(F.col(COUNT) == 0, F.lit(otherwise if missing is None else missing))
    for floor, name in bands:
        label = label.when(F.col(SUM) >= F.col(COUNT) * F.lit(floor * 10**scale), F.lit(name))
    return label.otherwise(F.lit(otherwise))
