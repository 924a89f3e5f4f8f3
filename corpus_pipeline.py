"""A corpus from raw documents to piece ids, stage by stage.

Each stage takes what its predecessor kept, as rows with the columns of
``documents``; the last one adds the piece ids.  Rows are neither capped nor
sampled; only toxic documents, near copies and what the mix does not draw go.
NULL, empty and very long texts, repeated rows, empty tables and further
columns are handled as each operator's docstring says; further columns pass
through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollbook.functions.staging import stage
from rollbook.llm import minhash, mixing, pieces, pii, toxicity
from rollbook.llm.common import table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions, documents repeated accordingly."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids under merge-dropout: doc_id, n_pieces, lossless, ids."""
    # fewer paths than by itself: executors hold what the stages before have left in their heaps
    return pieces.encode(docs, remember=120_000).select("doc_id", "n_pieces", "lossless", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("near duplicates", distinct),
    ("personal data", private),
    ("mixing", mixed),
    ("pieces", encoded),
]

#: Learned stages and merge-dropout have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs)
    return docs
