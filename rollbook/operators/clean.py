"""Cleaning: missing keys, projections, types, defaults, added columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.text import NA_TOKENS, fit_text, na_to_null


def blank_missing(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Turn NA literals of every text column into NULL."""
    return df.select(
        *[
            na_to_null(f.name, tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_missing(df: DataFrame, keys: Sequence[str], tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Drop rows whose key columns are NULL or an NA literal."""
    return blank_missing(df, tokens).dropna(subset=list(keys))


def rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project feed columns to table columns: ``{feed name: table name}``."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types; what does not convert becomes NULL.

    Decimals round half away from zero.  Pair it with the ``number`` and
    ``real_date`` rules, which report the values lost here.
    """
    return df.select(
        *[
            F.col(c).try_cast(schema[c].dataType).alias(c) if c in schema.names else F.col(c)
            for c in df.columns
        ]
    )


def fit_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Drop trailing blanks beyond each column's limit."""
    present = {c: fit_text(c, n) for c, n in limits.items() if c in df.columns}
    return df.withColumns(present) if present else df


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill a default only where the column is absent; a given NULL stays."""
    missing = {c: value for c, value in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add declared columns that are absent, as typed NULLs."""
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the declared column order and types, absent columns NULL."""
    return evolve(df, schema).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
