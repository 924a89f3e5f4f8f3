"""Written intermediate tables.

A few steps need rows that do not change when an executor is lost, above all
id assignment, and some results have several consumers.  Such rows are written
as Parquet to the shared checkpoint folder and read back, which also cuts the
lineage.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_local = threading.local()


def staging_root(spark: SparkSession) -> str:
    """The folder the session names; a local session without one gets its own."""
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"set {_KEY} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="rollbook-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once, closely packed, and return the written rows."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged-{uuid.uuid4().hex}"
    for paths in getattr(_local, "scopes", []):
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside.

    For callers whose results are written by then, such as a publish; frames
    built inside must not be used afterwards.
    """
    scopes = _local.__dict__.setdefault("scopes", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        yield
    finally:
        scopes.remove(paths)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
