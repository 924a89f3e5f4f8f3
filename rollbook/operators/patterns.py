"""Calendar rows, seeded samples and template children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.joins import distinct_keys
from rollbook.operators.keys import assign_ids


def calendar_spine(
    entities: DataFrame,
    start: Column | str,
    days: int = 15,
    weekdays_only: bool = True,
    name: str = "class_date",
) -> DataFrame:
    """One row per entity and day, ``days`` consecutive days from ``start``."""
    first = F.to_date(start)
    spine = entities.withColumn(name, F.explode(F.sequence(first, F.date_add(first, days - 1))))
    return spine.where(F.weekday(name) < 5) if weekdays_only else spine


def draw(seed: int, *parts: Column) -> Column:
    """A non-negative 60-bit number that depends on seed and parts only."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample_per_group(
    groups: DataFrame,
    items: DataFrame,
    group_id: str,
    item_id: str,
    k: Column | int,
    seed: int,
) -> DataFrame:
    """``k`` distinct items per group without replacement, reproducible by seed.

    Items are numbered in id order and every group draws ``k`` distinct
    positions by Floyd's method: step ``j`` takes a random position up to ``j``,
    or ``j`` itself if that one is taken.  The work is k rows per group; groups
    and items are never paired up.
    """
    numbered = assign_ids(items.select(item_id), "_pos", 0, order=[item_id])
    size = numbered.count()
    want = F.least(F.lit(k) if isinstance(k, int) else k, F.lit(size)).cast("bigint")

    def step(taken: Column, j: Column) -> Column:
        at = F.pmod(draw(seed, F.col(group_id), j), j + 1)
        return F.array_append(taken, F.when(F.array_contains(taken, at), j).otherwise(at))

    none = F.array().cast("array<bigint>")
    steps = F.when(want > 0, F.sequence(F.lit(size).cast("bigint") - want, F.lit(size - 1).cast("bigint")))
    drawn = groups.select(group_id, F.explode(F.aggregate(steps, none, step)).alias("_pos"))
    return drawn.join(numbered, "_pos").select(group_id, item_id)


def backfill_children(
    parents: DataFrame,
    children: DataFrame,
    fk: str,
    template: Sequence[dict[str, Column]],
) -> DataFrame:
    """The template's rows for every parent that has no child yet."""
    childless = parents.select(fk).join(distinct_keys(children, [fk]), fk, "left_anti")
    rows = F.array(*[F.struct(*[v.alias(c) for c, v in row.items()]) for row in template])
    return childless.select(fk, F.inline(rows))
