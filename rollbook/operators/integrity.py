"""Key and reference checks, and deletes that follow references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.joins import all_set
from rollbook.functions.staging import stage


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(parents, fk, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """(checked, failed) of a reference; copies of a reference are folded first."""
    refs = child.groupBy(fk).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(pk).alias(fk), F.lit(True).alias("_known"))
    lost = F.col(fk).isNotNull() & F.col("_known").isNull()
    return refs.join(known, fk, "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(lost, F.col("_rows"))), F.lit(0)).alias("failed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    """Complete keys that occur more than once."""
    return (
        df.where(all_set(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) > 1)
    )


def cascade_delete(
    tables: Mapping[str, DataFrame],
    root: str,
    keys_df: DataFrame,
    fk_graph: Sequence[tuple[str, str, str, str]] = tuple(schemas.FOREIGN_KEYS),
    primary_keys: Mapping[str, str] = schemas.PRIMARY_KEYS,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(kept tables, deleted rows per table) after deleting ``keys_df`` from ``root``.

    ``keys_df`` holds the root's primary key.  ``fk_graph`` lists parents before
    children.  A row falls with the first of its references that falls; a NULL
    reference keeps it.  The ids that fall are written per table: they are looked
    up several times, and Spark then knows whether they are small.
    """
    kept = dict(tables)
    root_key = primary_keys[root]
    doomed = stage(keys_df.select(root_key).where(F.col(root_key).isNotNull()).distinct())
    fallen = {root: doomed}
    deleted = {root: tables[root].join(doomed, root_key, "left_semi")}
    kept[root] = tables[root].join(doomed, root_key, "left_anti")
    for child in dict.fromkeys(edge[0] for edge in fk_graph):
        falls = [
            (fk, fallen[parent].select(F.col(pk).alias(fk)))
            for c, fk, parent, pk in fk_graph
            if c == child and parent in fallen
        ]
        if not falls or child not in tables:
            continue
        rest, gone = tables[child], []
        for fk, keys in falls:
            gone.append(rest.join(keys, fk, "left_semi"))
            rest = rest.join(keys, fk, "left_anti")
        kept[child] = rest.select(*tables[child].columns)
        deleted[child] = reduce(DataFrame.unionByName, [g.select(*tables[child].columns) for g in gone])
        if any(parent == child for _, _, parent, _ in fk_graph):
            fallen[child] = stage(deleted[child].select(primary_keys[child]))
    return kept, deleted


def cascade_counts(kept: Mapping[str, DataFrame], deleted: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table, kept, deleted)."""
    parts = []
    for name, df in kept.items():
        parts.append(df.select(F.lit(name).alias("table"), F.lit(1).alias("_kept"), F.lit(0).alias("_deleted")))
        if name in deleted:
            parts.append(
                deleted[name].select(F.lit(name).alias("table"), F.lit(0).alias("_kept"), F.lit(1).alias("_deleted"))
            )
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("table")
        .agg(F.sum("_kept").alias("kept"), F.sum("_deleted").alias("deleted"))
    )
