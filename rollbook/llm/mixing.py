"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights under a cap on
repetition, and each document is emitted floor(rate) times plus one more time
with probability equal to the fraction, drawn from a hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.common import WORD, unit_interval
from rollbook.operators.keys import assign_ids


def words(text_col: str = "text") -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = (1, 2, 3), max_rate: float = 3.0) -> DataFrame:
    """From rows (source, size): source, source_size, target, rate, one row per source.

    Sources in order of code points, NULL last, take the weights in turn.  All
    words are shared by weight; a share above ``max_rate`` times the source's
    own words stops there, and what is left is shared anew among the others
    until none is above.  The level of the shares rises with each round, so a
    source once stopped stays so.  Each round is one aggregate over sources.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("_null", F.col("source").isNull())
    ranked = assign_ids(totals, "_rank", 0, order=["_null", "source"])
    picks = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("_weight", F.element_at(picks, (F.col("_rank") % len(weights) + 1).cast("int")))
    ranked = stage(ranked.withColumn("_cap", F.col("source_size") * F.lit(float(max_rate))))
    whole = ranked.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    total, level, capped = whole["size"] or 0, (whole["size"] or 0) / (whole["weight"] or 1), -1
    spare, open_weight = float(total), float(whole["weight"] or 1)
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_cap")
        now = ranked.agg(
            F.count(F.when(above, 1)).alias("capped"),
            F.sum(F.when(above, F.col("_cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        if now["capped"] == capped or not now["weight"]:
            break
        capped, spare, open_weight = now["capped"], total - now["held"], now["weight"]
        level = spare / open_weight
    target = F.when(above, F.col("_cap")).otherwise(F.lit(spare) * F.col("_weight") / F.lit(open_weight))
    rate = F.when(above, F.lit(float(max_rate))).when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return ranked.select("source", "source_size", target.alias("target"), F.least(rate, F.lit(float(max_rate))).alias("rate"))


def copies(rate: Column, *keys: Column) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    extra = F.when(unit_interval(*keys) < rate - F.floor(rate), 1).otherwise(0)
    return (F.floor(rate) + extra).cast("int")


def _keys(seed: int, id_col: str, text_col: str) -> list[Column]:
    """The text counts only where the id is missing: those rows are not all alike."""
    return [F.lit(seed), F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col))]


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_rate: float = 3.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, size, source, source_size, target, copies, taken (words of all its copies).

    A NULL text has size 0, a NULL source is a source of its own, a source
    without words has target 0, NULL ids draw by their text, repeated rows
    draw alike, an empty table gives no rows.  Other columns are not read.
    """
    sized = stage(
        docs.select(
            F.col(id_col).alias(id_col),
            F.col(source_col).alias("source"),
            words(text_col).alias("size"),
            F.xxhash64(*_keys(seed, id_col, text_col)).alias("_draw"),
        )
    )
    rates = source_targets(sized, weights, max_rate).withColumnRenamed("source", "_source")
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    joined = joined.withColumn("copies", copies(F.col("rate"), F.col("_draw")))
    return joined.select(
        id_col, "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_rate: float = 3.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents themselves, each as often as ``mix_plan`` says, with the columns of ``docs``."""
    sized = docs.select(F.col(source_col).alias("source"), words(text_col).alias("size"))
    rates = source_targets(sized, weights, max_rate)
    rates = rates.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"))
    packed = docs.select(
        F.struct("*").alias("_row"), F.col(source_col).alias("_source"), F.xxhash64(*_keys(seed, id_col, text_col)).alias("_draw")
    )
    joined = packed.join(rates, F.col("_source").eqNullSafe(F.col("_mix_source")), "left")
    times = F.array_repeat(F.lit(1), copies(F.col("_mix_rate"), F.col("_draw")))
    return joined.select("_row", F.explode(times)).select("_row.*")
