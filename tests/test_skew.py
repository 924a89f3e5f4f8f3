"""A third of the rows on one key: the large joins must be split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollbook.functions.joins import null_safe_left
from rollbook.operators import integrity, lookup
from rollbook.plans import reports as A

N = 120_000
TIGHT = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@pytest.fixture
def tight(spark):
    """No broadcasts, and sizes at which a test table counts as large."""
    old = {k: spark.conf.get(k, None) for k in TIGHT}
    for k, v in TIGHT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def lopsided(spark, tmp_path):
    i = F.col("id")
    hot = F.when(i % 3 == 0, F.lit(7))
    tables = {
        "enrollments": spark.range(N).select(
            i.alias("enrollment_id"),
            hot.otherwise(i % 2000).alias("student_id"),
            F.when(i % 3 == 1, F.lit(5)).otherwise(i % 50).cast("long").alias("course_id"),
            F.concat(F.lit("S"), i).alias("semester"),
        ),
        "grades": spark.range(N).select(
            hot.otherwise(i).alias("enrollment_id"),
            F.concat(F.lit("T"), i % 3).alias("assessment_type"),
            (i % 100).cast("decimal(5,2)").alias("score"),
        ),
        "students": spark.range(2000).select(
            i.alias("student_id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"), F.concat(F.lit("e"), i).alias("email")
        ),
        "courses": spark.range(50).select(
            i.alias("course_id"), F.concat(F.lit("C"), i).alias("course_code"), F.lit("n").alias("course_name"), F.lit(3).alias("credits")
        ),
        "calls": spark.range(N).select(
            i.alias("seq"),
            F.concat(F.lit("e"), hot.otherwise(i % 2000)).alias("email"),
            F.concat(F.lit("C"), F.when(i % 3 == 0, 1).otherwise(i % 50)).alias("course_code"),
        ),
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in tables}


def splits(df) -> int:
    """Joins of the finished plan that were split for skew."""
    done = df._jdf.queryExecution()
    done.toRdd().count()
    return done.executedPlan().toString().split("== Initial Plan ==")[0].count("skew=true")


def test_hot_student_and_course_in_transcripts(tight, lopsided):
    t = lopsided
    assert splits(A.transcripts(t["students"], t["courses"], t["enrollments"], t["grades"])) >= 2


def test_hot_reference(tight, lopsided):
    t = lopsided
    assert splits(integrity.orphans(t["grades"], t["enrollments"], "enrollment_id", "enrollment_id")) == 1
    kept, deleted = integrity.cascade_delete(t, "students", t["students"].where("student_id < 9"))
    assert splits(kept["grades"]) == 1 and splits(deleted["enrollments"]) == 1


def test_hot_command_key(tight, lopsided):
    t = lopsided
    links = lookup.link_pairs(t["calls"], t["students"], t["courses"], t["enrollments"])
    assert splits(null_safe_left(t["calls"], links, ["email", "course_code"])) == 1


def test_hot_enrollment_is_folded_before_the_shuffle(tight, lopsided):
    means = A.enrollment_means(lopsided["grades"])
    assert means.where("enrollment_id = 7").first()["_rows"] == N // 3 + 1
    text = means._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum") > text.index("Exchange") > -1
