"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: whatever stands between the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(values: Iterable[object], ddl: str) -> Column:
    """A constant of a nested type, folded once instead of one expression per element."""
    return F.from_json(F.lit(json.dumps(list(values))), ddl)


def unit_interval(*keys: Column) -> Column:
    """A reproducible number in [0, 1) made of the keys."""
    low = F.xxhash64(*keys).bitwiseAND(F.lit((1 << 52) - 1))
    return low / F.lit(float(1 << 52))


def spans_of(text: str, pattern: str, possible: Column | None = None) -> tuple[Column, Column]:
    """Matches of a pattern and the lengths of the gaps before them, to be kept as two columns.

    ``possible`` is a cheap test without which the pattern cannot match.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(F.col(text), pattern, -1), F.length)
    if possible is None:
        return found, gaps
    none = F.lit(None)
    return F.when(possible, found).otherwise(none.cast("array<string>")), F.when(possible, gaps).otherwise(
        none.cast("array<int>")
    )


def placed(found: Column, gaps: Column) -> Column:
    """Array of (start, end, surface) in code points from what ``spans_of`` gave."""
    step = F.zip_with(
        found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(0))), lambda m, g: F.struct(g.alias("gap"), F.length(m).alias("len"))
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        step,
        zero,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts"),
        ),
    )["starts"]
    rows = F.zip_with(
        starts, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("surface"))
    )
    return F.when(F.size(found) > 0, rows).otherwise(F.array().cast("array<struct<start:int,end:int,surface:string>>"))


def span_list(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas; spans have kind, start and end."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")
        ),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
