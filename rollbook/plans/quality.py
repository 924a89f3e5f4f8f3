"""Data-quality checks as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.joins import all_set
from rollbook.operators.integrity import orphan_count
from rollbook.operators.rules import Rule

# Accepted volumes: more than 100 students, 20 to 40 courses.
BOUNDS = {"students": (101, None), "courses": (20, 40)}


def row_count_checks(
    tables: Mapping[str, DataFrame],
    bounds: Mapping[str, tuple[int | None, int | None]] = BOUNDS,
) -> DataFrame:
    """(table, rows, low, high, passed); a missing bound is open."""
    parts = []
    for name, df in tables.items():
        low, high = bounds.get(name, (None, None))
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                "rows",
                F.lit(low).cast("bigint").alias("low"),
                F.lit(high).cast("bigint").alias("high"),
            )
        )
    in_bounds = (F.col("rows") >= F.coalesce("low", "rows")) & (F.col("rows") <= F.coalesce("high", "rows"))
    return reduce(DataFrame.unionAll, parts).withColumn("passed", in_bounds)


def rule_counts(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """(rule, table, checked, failed) of all rules in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(~r.holds).alias(r.reason) for r in rules],
    )
    pairs = F.array(*[F.struct(F.lit(r.reason).alias("rule"), F.col(r.reason).alias("failed")) for r in rules])
    return counts.select("checked", F.inline(pairs)).select(
        "rule", F.lit(table).alias("table"), "checked", "failed"
    )


def key_counts(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Surplus rows of repeated complete keys, in one pass over the table."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    surplus = F.when(all_set(keys), F.col("_copies") - 1)
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("checked"), F.coalesce(F.sum(surplus), F.lit(0)).alias("failed")
    ).select(F.lit("unique_" + "_".join(keys)).alias("rule"), F.lit(table).alias("table"), "checked", "failed")


def reference_counts(child: DataFrame, parent: DataFrame, table: str, fk: str, pk: str) -> DataFrame:
    return orphan_count(child, parent, fk, pk).select(
        F.lit(f"orphan_{fk}").alias("rule"), F.lit(table).alias("table"), "checked", "failed"
    )


def dq_summary(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence[Rule]],
    keys: Sequence[tuple[str, Sequence[str]]] = tuple(
        [(t, [k]) for t, k in schemas.PRIMARY_KEYS.items()] + list(schemas.UNIQUE_KEYS.items())
    ),
    fks: Sequence[tuple[str, str, str, str]] = tuple(schemas.FOREIGN_KEYS),
    bounds: Mapping[str, tuple[int | None, int | None]] | None = None,
) -> DataFrame:
    """(rule, table, checked, failed, passed) over rules, keys, references and volumes."""
    parts = [rule_counts(tables[t], t, rs) for t, rs in rules.items() if rs]
    parts += [key_counts(tables[t], t, list(k)) for t, k in keys]
    parts += [reference_counts(tables[c], tables[p], c, fk, pk) for c, fk, p, pk in fks]
    if bounds:
        parts.append(
            row_count_checks({t: tables[t] for t in bounds}, bounds).select(
                F.lit("row_count").alias("rule"),
                "table",
                F.col("rows").alias("checked"),
                F.when(F.col("passed"), 0).otherwise(1).cast("bigint").alias("failed"),
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failed") == 0)
