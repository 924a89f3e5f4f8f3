"""Reports that follow the publishes instead of reading the tables again.

Every publish writes, next to its rows, what they change in sums by student,
course and semester: plus for rows added, minus for rows deleted, the difference
for grades that change.  All sums are whole numbers, so they add up in any order,
and a report from them equals the report from the tables.  A report reads the
sums, a refresh only those of the publishes since.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.exact import COUNT, SUM, band, from_units, mean_units, merge_parts, units
from rollbook.functions.staging import stage, staging_scope
from rollbook.operators.clean import conform
from rollbook.plans.commands import Tables
from rollbook.plans.reports import pg_order
from rollbook.sources.store import TableStore, folded

_KEY = ["student_id", "course_id", "semester"]
_SUMS = ["enrolled", "assessments", "sum_units", "scored", "classes", "attended"]


def _parts(rows: DataFrame, **sums: Column) -> DataFrame:
    """Sums by enrollment, 0 for those not given; copies of an enrollment are folded in the tasks that read them."""
    values = [F.coalesce(sums.get(s, F.lit(0)), F.lit(0)).cast("bigint").alias(s) for s in _SUMS[1:]]
    return rows.groupBy("enrollment_id").agg(*values)


def signed_facts(
    before: Tables, append: Mapping[str, DataFrame] | None = None, changes: DataFrame | None = None
) -> DataFrame:
    """What added rows and changed grades alter.

    Rows are folded by enrollment, and the folded ones of all tables are added up
    before they meet the enrollments, once; rows of unknown enrollments go.  A
    change takes back what it replaces, so it meets the old grades of its key, as
    the change itself does.
    """
    new = {name: conform(df, schemas.TABLES[name]) for name, df in (append or {}).items()}
    enrollments = conform(before["enrollments"], schemas.ENROLLMENTS).select("enrollment_id", *_KEY)
    out, parts = [], []
    if "enrollments" in new:
        enrolled = [F.lit(int(s == "enrolled")).cast("bigint").alias(s) for s in _SUMS]
        out.append(new["enrollments"].select(*_KEY, *enrolled))
        enrollments = enrollments.unionByName(new["enrollments"].select("enrollment_id", *_KEY))
    if "grades" in new:
        score = F.sum(units(F.col("score")))
        parts.append(_parts(new["grades"], assessments=F.count("*"), sum_units=score, scored=F.count("score")))
    if "attendance" in new:
        present = F.when(F.col("status").isin(*schemas.ATTENDED), 1).otherwise(0)
        parts.append(_parts(new["attendance"], classes=F.count("*"), attended=F.sum(present)))
    if changes is not None:
        old = before["grades"].select("enrollment_id", "assessment_type", "score")
        met = old.join(changes.select("enrollment_id", "assessment_type", "new_score"), ["enrollment_id", "assessment_type"])
        value = lambda c: F.coalesce(units(F.col(c)), F.lit(0))
        is_set = lambda c: F.col(c).isNotNull().cast("bigint")
        more = {"sum_units": F.sum(value("new_score") - value("score")), "scored": F.sum(is_set("new_score") - is_set("score"))}
        parts.append(_parts(met, **more))
    if parts:
        total = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            total = total.groupBy("enrollment_id").agg(*[F.sum(s).alias(s) for s in _SUMS[1:]])
        out.append(enrollments.join(total, "enrollment_id").select(*_KEY, F.lit(0).cast("bigint").alias("enrolled"), *_SUMS[1:]))
    if not out:
        raise ValueError("nothing to account for")
    return folded(reduce(DataFrame.unionByName, out))


def taken_back(facts: DataFrame, students: DataFrame) -> DataFrame:
    """What deleting students with all that refers to them alters: their sums, negative."""
    theirs = facts.join(students.select("student_id").distinct(), "student_id", "left_semi")
    return folded(theirs.select(*_KEY, *[(-F.col(s)).alias(s) for s in _SUMS]))


def publish(
    store: TableStore,
    append: Mapping[str, DataFrame] | None = None,
    changes: DataFrame | None = None,
    replace: Mapping[str, DataFrame] | None = None,
    deleted_students: DataFrame | None = None,
    batch: str = "",
) -> int:
    """Publish rows together with what they alter.

    ``append`` and ``changes`` are accounted for by themselves; ``replace`` only
    as the removal of ``deleted_students`` or, for students and courses, not at
    all: a report takes their names from the tables.
    """
    counted = [n for n in append or {} if n in ("enrollments", "grades", "attendance")]

    def altered(written: Mapping[str, DataFrame], changed: DataFrame | None) -> DataFrame:
        parts = []
        if counted or changed is not None:
            parts.append(signed_facts(store.read(), {n: written[n] for n in counted}, changed))
        if deleted_students is not None:
            parts.append(taken_back(store.facts(), deleted_students))
        return reduce(DataFrame.unionByName, parts)

    counts = bool(counted) or changes is not None or deleted_students is not None
    with staging_scope(store.spark):
        # replaced rows are put in ranges, which takes them twice: to draw the bounds and to deal them
        replace = {n: stage(df) for n, df in (replace or {}).items()}
        return store.publish(replace, append, changes, batch, facts=altered if counts else None)


# -- reports from facts -------------------------------------------------------


def course_performance(facts: DataFrame, courses: DataFrame) -> DataFrame:
    """As ``reports.course_performance``."""
    parts = facts.groupBy("course_id").agg(
        F.sum("assessments").alias("total_assessments"), F.sum("sum_units").alias(SUM), F.sum("scored").alias(COUNT)
    )
    report = parts.where("total_assessments > 0").join(courses.select("course_id", "course_code", "course_name"), "course_id")
    report = report.select(
        "course_code", "course_name", "total_assessments", from_units(mean_units()).alias("average_score"),
        band(schemas.TIERS, schemas.TIER_OTHERWISE).alias("performance_category"),
    )
    return pg_order(report, "average_score", tie=["course_code"])


def attendance_stats(facts: DataFrame) -> DataFrame:
    """As ``reports.attendance_stats``."""
    sums = [F.sum("classes").alias("total_classes"), F.sum("attended").alias("classes_attended")]
    return facts.groupBy("student_id", "course_id").agg(*sums).where("total_classes > 0")


def transcripts(facts: DataFrame, students: DataFrame, courses: DataFrame) -> DataFrame:
    """As ``reports.transcripts``."""
    parts = facts.select(*_KEY, "enrolled", F.col("sum_units").alias(SUM), F.col("scored").alias(COUNT))
    finals = parts.groupBy(*_KEY).agg(F.sum("enrolled").alias("enrolled"), *merge_parts()).where("enrolled > 0")
    rows = finals.join(students.select("student_id", "first_name", "last_name", "email"), "student_id")
    rows = rows.join(courses.select("course_id", "course_code", "course_name", "credits"), "course_id")
    return rows.select(
        "student_id", "first_name", "last_name", "email", "course_code", "course_name", "credits", "semester",
        from_units(mean_units()).alias("final_score"), band(schemas.LETTERS, schemas.LETTER_OTHERWISE, schemas.LETTER_MISSING).alias("letter_grade"),
    )
