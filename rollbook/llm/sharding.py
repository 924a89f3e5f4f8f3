"""Shards of near-equal size from sampled splitters.

Records are ordered by (hash of the text, hash of the id), so equal texts lie
side by side.  A sample drawn in proportion to size gives quantile splitters,
which cut that order into many cells; cells that come out overfull are cut
again.  Each cell is sorted in one task, its running sums start from the exact
total of the cells before it, and a record belongs to the shard in which its
middle byte falls.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.common import literal, unit_interval

#: Bytes that a record takes besides its text.
OVERHEAD = 16


def _splitters(keyed: DataFrame, cells: int, per_cell: int, total: int, seed: int) -> list[tuple[int, int]]:
    """Quantiles of a size-weighted sample: about ``cells * per_cell`` keys reach the driver."""
    rate = cells * per_cell / total
    chance = F.col("_size") * F.lit(rate)
    drawn = (
        keyed.filter(unit_interval(F.lit(seed), "_k1", "_k2", "_k3") < chance)
        .select("_k1", "_k2", (F.greatest(chance, F.lit(1.0)) / F.lit(rate)).alias("weight"))
        .collect()
    )
    drawn.sort(key=lambda r: (r["_k1"], r["_k2"]))
    sums = list(accumulate(r["weight"] for r in drawn))
    if not sums:
        return []
    at = {bisect_right(sums, sums[-1] * i / cells) for i in range(1, cells)}
    return sorted({(drawn[i]["_k1"], drawn[i]["_k2"]) for i in at if i < len(drawn)})


def _cell(splitters: list[tuple[int, int]]) -> Column:
    """How many splitters are not above a record's key; looked up in two steps of about the square root."""
    if not splitters:
        return F.lit(0)
    width = max(1, int(len(splitters) ** 0.5))
    rows = [{"a": a, "b": b} for a, b in splitters]
    blocks = [rows[i : i + width] for i in range(0, len(rows), width)]
    item = "struct<a:bigint,b:bigint>"
    heads = literal([x[0] for x in blocks], f"array<{item}>")
    inner = literal(blocks, f"array<array<{item}>>")
    below = lambda s: (s["a"] < F.col("_k1")) | ((s["a"] == F.col("_k1")) & (s["b"] <= F.col("_k2")))
    block = F.size(F.filter(heads, below))
    rest = F.size(F.filter(F.element_at(inner, block), below))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * F.lit(width) + rest)


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
    cells_per_shard: int = 32,
    cell_rows: int = 2_000_000,
    sample_per_cell: int = 16,
    carry: bool = False,
) -> DataFrame:
    """One row per record: id, size, text_crc32, shard, slot; with ``carry`` also all columns in a struct ``row``.

    Size is the UTF-8 bytes of the text plus 16; a NULL text has none and the
    checksum of no bytes.  NULL ids are keys like others, repeated rows each
    get a slot of their own (a third sort key is given as rows are written, so
    even a third of all rows that agree in everything can be cut), an empty
    table gives no rows.  Only the three named columns are read (all with
    ``carry``), so other columns may have any name.  Shard sizes differ by one
    record at most; slots count from 0 without gaps.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.xxhash64(text).alias("_k1"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_k2"),
        *([F.struct("*").alias("_row")] if carry else []),
    ).withColumn("_k3", F.monotonically_increasing_id())
    keyed = stage(keyed)
    whole = keyed.agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).first()
    total, rows = whole["size"] or 1, whole["rows"]
    cells = max(shards * cells_per_shard, -(-rows // cell_rows))
    ranged = keyed.withColumn("_cell", _cell(_splitters(keyed, cells, sample_per_cell, total, seed)))

    # overfull cells, as of one text or one record many times, are cut evenly by the third key
    limit_rows, limit_size = max(1, 3 * rows // cells), max(1, 3 * total // cells)
    sums = ranged.groupBy("_cell").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    parts = [1] * (max((r["_cell"] for r in sums), default=0) + 1)
    for r in sums:
        parts[r["_cell"]] = max(-(-r["rows"] // limit_rows), min(r["rows"], -(-r["size"] // limit_size)))
    cut = F.element_at(literal(parts, "array<int>"), F.col("_cell") + 1)
    ranged = ranged.withColumn("_part", F.pmod(F.xxhash64("_k3"), cut.cast("long")))

    # what lies before each part: as many numbers as there are parts
    sums = ranged.groupBy("_cell", "_part").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    sums.sort(key=lambda r: (r["_cell"], r["_part"]))
    before: list[list[dict]] = [[{"size": 0, "rows": 0}] * p for p in parts]
    size = count = 0
    for r in sums:
        before[r["_cell"]][r["_part"]] = {"size": size, "rows": count}
        size, count = size + r["size"], count + r["rows"]
    base = F.element_at(
        F.element_at(literal(before, "array<array<struct<size:bigint,rows:bigint>>>"), F.col("_cell") + 1),
        (F.col("_part") + 1).cast("int"),
    )
    order = Window.partitionBy("_cell", "_part").orderBy("_k1", "_k2", "_k3")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * (base["size"] + F.sum("_size").over(running)) - F.col("_size")
    placed = ranged.select(
        "*",
        F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * total))).cast("int").alias("_shard"),
        (base["rows"] + F.row_number().over(order) - 1).cast("long").alias("_at"),
    )
    placed = stage(placed.drop("_k1", "_k2", "_k3", "_cell", "_part"))
    first = {r["_shard"]: r["at"] for r in placed.groupBy("_shard").agg(F.min("_at").alias("at")).collect()}
    firsts = literal([first.get(i, 0) for i in range(shards)], "array<bigint>")
    return placed.select(
        id_col,
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_at") - F.element_at(firsts, F.col("_shard") + 1)).alias("slot"),
        *([F.col("_row").alias("row")] if carry else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, **options: object) -> None:
    """Write all columns of ``docs`` into folders ``shard=N`` below ``path``; ``docs`` must not have a column ``shard``."""
    placed = assign_shards(docs, shards, carry=True, **options)
    files = F.floor(F.col("slot") / F.lit(1_000_000))
    placed.withColumn("_file", files).repartition("shard", "_file").select("row.*", "shard").write.partitionBy("shard").parquet(path)
