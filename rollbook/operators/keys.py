"""Business keys: insert what is new, give surrogate ids, count what happened."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.joins import all_set, distinct_keys
from rollbook.functions.staging import stage

_LOW_BITS = (1 << 33) - 1


def _pick(batch: DataFrame, keys: Sequence[str], order: Sequence[str], extreme: Callable[[Column], Column]) -> DataFrame:
    """One row per key, the extreme one when order and then the other columns are compared."""
    lead = [c for c in order if c not in keys]
    rest = [c for c in batch.columns if c not in keys and c not in lead]
    if not lead + rest:
        return batch.distinct()
    row = extreme(F.struct(*lead, *rest)).alias("_row")
    return batch.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*batch.columns)


def first_wins(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by ``order``; rows with a NULL key all stay.

    The pick is an aggregate, so copies of a hot key are folded in the tasks
    that read them and only one row per task and key is shuffled.
    """
    complete = _pick(batch.where(all_set(keys)), keys, order, F.min)
    return complete.unionByName(batch.where(~all_set(keys)))


def last_wins(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key by ``order``; keys must be complete."""
    return _pick(batch, keys, order, F.max)


def present_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch's keys that the target already holds.

    Written from the target's side: a small batch is broadcast and the target
    is only scanned, a large one joins on the shuffled keys.
    """
    return target.select(*keys).join(distinct_keys(batch, keys), list(keys), "left_semi")


def insert_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows skipped) under UNIQUE(keys) with the first row winning.

    NULL keys never conflict, neither inside the batch nor with the target.
    ``order`` must tell any two rows of one key apart.  The batch and the keys
    that the target holds of it are written once and serve both results.
    """
    keys = list(keys)
    batch = stage(batch)
    firsts = first_wins(batch, keys, order)
    inserted = firsts.join(stage(present_keys(target, batch, keys)), keys, "left_anti").select(*batch.columns)
    identity = [*keys, *[c for c in order if c not in keys]]
    same = F.lit(True)
    for c in identity:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"i.{c}"))
    skipped = (
        batch.where(all_set(keys)).alias("b").join(inserted.select(*identity).alias("i"), same, "left_anti")
    )
    return inserted, skipped


def next_id(target: DataFrame, id_col: str) -> int:
    """One more than the highest id in use; a single aggregate row is fetched."""
    row = target.agg(F.max(id_col).alias("top")).first()
    return (row["top"] or 0) + 1


def assign_ids(
    rows: DataFrame,
    id_col: str,
    start: int,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Dense ids ``start, start + 1, ..`` that stay as they are once given.

    Rows are numbered inside their partition, written once, and shifted by the
    row counts of the partitions before them.  Those counts are one number per
    partition; no task sees more than its own rows.  With ``order`` the ids
    follow that order (range partitioning).
    """
    numbered = (rows.orderBy(*order) if order else rows).withColumn("_at", F.monotonically_increasing_id())
    written = stage(numbered)
    part = F.shiftright("_at", 33)
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    new_id = F.col("_shift") + F.col("_at").bitwiseAND(F.lit(_LOW_BITS)) + F.lit(start)
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")  # one row per partition
        .withColumn(id_col, new_id.cast("bigint"))
        .drop("_part", "_shift", "_at")
    )


def load_counters(
    extracted: DataFrame,
    kept: DataFrame,
    processed: DataFrame,
    inserted: DataFrame,
) -> DataFrame:
    """Rows (metric, rows) of one load.

    ``processed`` counts the rows offered to the target, conflicting ones
    included; ``inserted`` only those that entered it.
    """
    counts = {"extracted": extracted, "kept": kept, "processed": processed, "inserted": inserted}
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("step"), "n") for name, df in counts.items()
    ]
    # skipped = processed - inserted, from the four numbers
    sign = F.when(F.col("step") == "processed", 1).when(F.col("step") == "inserted", -1).otherwise(0)
    own = F.struct(F.col("step").alias("metric"), F.col("n").alias("rows"))
    gap = F.struct(F.lit("skipped").alias("metric"), (F.col("n") * sign).alias("rows"))
    return (
        reduce(DataFrame.unionAll, parts)
        .select(F.inline(F.array(own, gap)))
        .groupBy("metric")
        .agg(F.sum("rows").alias("rows"))
    )
