"""The analytical reports.

All of them first reduce the large fact table to one small row per enrollment
(sum and count, or two counts), so only partial results are joined and every
hot enrollment, student or course is folded before it is shuffled.  Names and
codes are looked up after the last aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.exact import (
    COUNT,
    band,
    from_units,
    half_up_ratio,
    mean_parts,
    mean_units,
    merge_parts,
)
from rollbook.functions.joins import all_set
from rollbook.functions.staging import stage
from rollbook.operators.lookup import with_match

_ROWS = "_rows"


def pg_order(df: DataFrame, measure: str, descending: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """Sort by a measure with NULL first on descending and last on ascending order."""
    lead = F.col(measure).desc_nulls_first() if descending else F.col(measure).asc_nulls_last()
    return df.orderBy(lead, *[F.col(c).asc_nulls_last() for c in tie])


# -- means ------------------------------------------------------------------


def tiered_mean(
    fact: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    tiers: Sequence[tuple[int, str]] = schemas.TIERS,
    otherwise: str = schemas.TIER_OTHERWISE,
    null_label: str | None = None,
    mean_name: str = "average_score",
    label_name: str = "performance_category",
) -> DataFrame:
    """Per key: rounded mean and the label its unrounded value earns."""
    parts = fact.groupBy(*keys).agg(*mean_parts(score))
    return parts.select(
        *keys,
        from_units(mean_units()).alias(mean_name),
        band(tiers, otherwise, null_label).alias(label_name),
    )


def top_mean(
    fact: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    min_count: int = 3,
    k: int = 10,
    tie: Sequence[str] | None = None,
    mean_name: str = "overall_gpa",
) -> DataFrame:
    """The ``k`` best means among keys with at least ``min_count`` values."""
    parts = fact.groupBy(*keys).agg(*mean_parts(score))
    return _top(parts, list(keys), min_count, k, list(tie or keys), mean_name)


def _named_top(
    per_student: DataFrame, students: DataFrame, names: list[str], min_count: int, k: int, mean_name: str
) -> DataFrame:
    """The best students that exist; names are looked up for these few only."""
    there = with_match(per_student, students, ["student_id"])
    best = _top(there, ["student_id"], min_count, k, ["student_id"], mean_name)
    named = best.join(students.select("student_id", *names), "student_id")
    return pg_order(named.select("student_id", *names, mean_name), mean_name, tie=["student_id"])


def _top(
    parts: DataFrame, keep: list[str], min_count: int, k: int, tie: list[str], mean_name: str
) -> DataFrame:
    means = parts.where(F.col(COUNT) >= min_count).select(*keep, from_units(mean_units()).alias(mean_name))
    return pg_order(means, mean_name, tie=tie).limit(k)


def enrollment_means(grades: DataFrame) -> DataFrame:
    """One row per graded enrollment: rows, sum and count of scores."""
    return (
        grades.where(F.col("enrollment_id").isNotNull())
        .groupBy("enrollment_id")
        .agg(F.count(F.lit(1)).alias(_ROWS), *mean_parts("score"))
    )


def course_performance(courses: DataFrame, enrollments: DataFrame, grades: DataFrame) -> DataFrame:
    """Assessment count, mean and tier of every graded course, best first."""
    per_course = (
        enrollments.select("enrollment_id", "course_id")
        .join(enrollment_means(grades), "enrollment_id")
        .groupBy("course_id")
        .agg(F.sum(_ROWS).alias("total_assessments"), *merge_parts())
    )
    report = per_course.join(courses.select("course_id", "course_code", "course_name"), "course_id").select(
        "course_code",
        "course_name",
        "total_assessments",
        from_units(mean_units()).alias("average_score"),
        band(schemas.TIERS, schemas.TIER_OTHERWISE).alias("performance_category"),
    )
    return pg_order(report, "average_score", tie=["course_code"])


def deans_list(
    students: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    min_count: int = 3,
    k: int = 10,
) -> DataFrame:
    """Students with the best mean over all their scores."""
    per_student = (
        enrollments.select("enrollment_id", "student_id")
        .join(enrollment_means(grades), "enrollment_id")
        .groupBy("student_id")
        .agg(*merge_parts())
        .where(F.col(COUNT) >= min_count)
    )
    return _named_top(per_student, students, ["first_name", "last_name", "major"], min_count, k, "overall_gpa")


# -- transcripts ------------------------------------------------------------


def _finals(enrollments: DataFrame, grades: DataFrame) -> DataFrame:
    """Mean parts per (student, course, semester), ungraded enrollments kept."""
    return (
        enrollments.where(all_set(["student_id", "course_id"]))
        .select("enrollment_id", "student_id", "course_id", "semester")
        .join(enrollment_means(grades), "enrollment_id", "left")
        .groupBy("student_id", "course_id", "semester")
        .agg(*merge_parts())
    )


def transcripts(
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    letters: Sequence[tuple[int, str]] = schemas.LETTERS,
    otherwise: str = schemas.LETTER_OTHERWISE,
    null_label: str = schemas.LETTER_MISSING,
) -> DataFrame:
    """Final score and letter per student, course and semester.

    Emails and codes are unique, so grouping by the ids groups as the names do.
    """
    return (
        _finals(enrollments, grades)
        .join(students.select("student_id", "first_name", "last_name", "email"), "student_id")
        .join(courses.select("course_id", "course_code", "course_name", "credits"), "course_id")
        .select(
            "student_id",
            "first_name",
            "last_name",
            "email",
            "course_code",
            "course_name",
            "credits",
            "semester",
            from_units(mean_units()).alias("final_score"),
            band(letters, otherwise, null_label).alias("letter_grade"),
        )
    )


def transcripts_for(
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    requests: DataFrame,
) -> DataFrame:
    """Transcripts of the requested emails only.

    The requests reduce students, these the enrollments, these the grades,
    before anything is folded.  The enrollments are written, so their size
    decides how the grades are reduced: by a broadcast, or by the shuffle that
    the fold needs anyway.
    """
    people = with_match(students, requests, ["email"])
    theirs = enrollments.select("enrollment_id", "student_id", "course_id", "semester").join(
        people.select("student_id"), "student_id", "left_semi"
    )
    theirs = stage(theirs)
    return transcripts(people, courses, theirs, with_match(grades, theirs, ["enrollment_id"]))


def deans_list_by_course(
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    min_count: int = 4,
    k: int = 10,
) -> DataFrame:
    """Students with the best mean of their final scores, one per course and semester."""
    finals = (
        _finals(enrollments, grades)
        .join(courses.select("course_id"), "course_id", "left_semi")
        .select("student_id", from_units(mean_units()).alias("final_score"))
    )
    per_student = finals.groupBy("student_id").agg(*mean_parts("final_score")).where(F.col(COUNT) >= min_count)
    return _named_top(per_student, students, ["first_name", "last_name"], min_count, k, "gpa")


# -- attendance -------------------------------------------------------------


def attendance_stats(
    attendance: DataFrame,
    enrollments: DataFrame,
    attended: Sequence[str] = schemas.ATTENDED,
) -> DataFrame:
    """Classes held and attended per student and course, all semesters together."""
    present = F.when(F.col("status").isin(*attended), 1).otherwise(0)
    per_enrollment = (
        attendance.where(F.col("enrollment_id").isNotNull())
        .groupBy("enrollment_id")
        .agg(F.count(F.lit(1)).alias("_total"), F.sum(present).alias("_attended"))
    )
    return (
        enrollments.select("enrollment_id", "student_id", "course_id")
        .join(per_enrollment, "enrollment_id")
        .groupBy("student_id", "course_id")
        .agg(F.sum("_total").alias("total_classes"), F.sum("_attended").alias("classes_attended"))
    )


def attendance_pct(scale: int = 1) -> Column:
    """Attended share in percent, rounded half up without leaving whole numbers."""
    ratio = half_up_ratio(F.col("classes_attended") * F.lit(100 * 10**scale), F.col("total_classes"))
    return from_units(ratio, 4, scale)


def at_risk(
    stats: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    threshold: tuple[int, int] = (3, 4),
) -> DataFrame:
    """Students whose attended share of a course is strictly below the threshold."""
    num, den = threshold
    low = stats.where(F.col("classes_attended") * den < F.col("total_classes") * num)
    report = (
        low.join(students.select("student_id", "first_name", "last_name"), "student_id")
        .join(courses.select("course_id", "course_code"), "course_id")
        .withColumn("attendance_pct", attendance_pct())
    )
    return pg_order(report, "attendance_pct", descending=False, tie=["student_id", "course_id"]).select(
        "first_name", "last_name", "course_code", "classes_attended", "total_classes", "attendance_pct"
    )


# -- enrollment counts ------------------------------------------------------


def enrollment_counts(
    courses: DataFrame,
    enrollments: DataFrame,
    by: Sequence[str] = ("course_name", "semester"),
) -> DataFrame:
    """Enrolled students per course name and semester; unused courses count 0."""
    per_course = enrollments.groupBy("course_id", "semester").agg(F.count("student_id").alias("_students"))
    report = (
        courses.select("course_id", *[c for c in by if c in courses.columns])
        .join(per_course, "course_id", "left")
        .groupBy(*by)
        .agg(F.coalesce(F.sum("_students"), F.lit(0)).alias("total_students"))
    )
    return pg_order(report, "total_students", tie=list(by))


# -- activity ---------------------------------------------------------------


def _activity_rows(grades: DataFrame, attendance: DataFrame) -> DataFrame:
    marks = grades.groupBy("enrollment_id", "assessment_type", "score").agg(F.count(F.lit(1)).alias("copies"))
    days = attendance.groupBy("enrollment_id", "status", "attendance_date").agg(F.count(F.lit(1)).alias("copies"))
    both = marks.withColumn("kind", F.lit("grade")).unionByName(
        days.withColumn("kind", F.lit("attendance")), allowMissingColumns=True
    )
    return both.where(F.col("enrollment_id").isNotNull())


def _activity_sizes(rows: DataFrame) -> DataFrame:
    def count_of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("copies")).otherwise(0))

    return rows.groupBy("enrollment_id").agg(
        count_of("grade").alias("n_grades"), count_of("attendance").alias("n_attendance")
    )


def _enrolled(students: DataFrame, courses: DataFrame, enrollments: DataFrame) -> DataFrame:
    return enrollments.join(
        students.select("student_id", "first_name", "last_name", "email"), "student_id"
    ).join(courses.select("course_id", "course_code"), "course_id")


def activity_log(
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    attendance: DataFrame,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Grades and attendance of every enrollment, without pairing them up.

    ``requests`` (email, course_code) narrows the log to the enrollments asked for.

    Two left joins from an enrollment to its m grades and n attendance rows
    give m x n rows.  Here each grade and each attendance row stands once with
    ``times``, the number of rows it has in that join, so the size stays
    m + n.  An enrollment with neither has one row of kind ``none``.
    """
    names = ["enrollment_id", "first_name", "last_name", "course_code"]
    wanted = _enrolled(students, courses, enrollments.select("enrollment_id", "student_id", "course_id"))
    if requests is not None:
        wanted = stage(with_match(wanted, requests, ["email", "course_code"]))
        grades, attendance = (with_match(t, wanted, ["enrollment_id"]) for t in (grades, attendance))
    rows = stage(_activity_rows(grades, attendance))
    base = stage(wanted.join(_activity_sizes(rows), "enrollment_id", "left").select(*names, "n_grades", "n_attendance"))
    other = F.when(F.col("kind") == "grade", F.col("n_attendance")).otherwise(F.col("n_grades"))
    listed = rows.join(base, "enrollment_id").select(
        *names,
        "kind",
        "assessment_type",
        "score",
        "status",
        "attendance_date",
        (F.col("copies") * F.greatest(other, F.lit(1))).alias("times"),
    )
    idle = base.where(F.col("n_grades").isNull()).select(
        *names, F.lit("none").alias("kind"), F.lit(1).cast("bigint").alias("times")
    )
    return listed.unionByName(idle, allowMissingColumns=True)


# -- text -------------------------------------------------------------------

# The texts of the two layouts.
RULE = "-" * 40
LISTING_HEADER = "Course Code | Course Name | Score | Grade"


def _lines(records: DataFrame, title: str, second: Column, body: Column) -> DataFrame:
    """Text lines of all transcripts as rows, in reading order by their columns.

    The heading lines come from one aggregate row per student.  No transcript
    is gathered into a single value, so its length does not matter.  The records
    are written, as both kinds of lines need them.
    """
    records = stage(records)
    name = F.concat_ws(" ", "first_name", "last_name")
    heads = records.groupBy("student_id").agg(F.min(name).alias("_name"))
    blank = F.lit("")
    head = heads.select(
        "student_id",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("block"),
                    blank.alias("course_code"),
                    blank.alias("semester"),
                    F.concat(F.lit(title + ": "), F.col("_name")).alias("line"),
                ),
                F.struct(
                    F.lit(1).alias("block"),
                    blank.alias("course_code"),
                    blank.alias("semester"),
                    second.alias("line"),
                ),
            )
        ),
    )
    rows = records.select(
        "student_id",
        F.lit(2).alias("block"),
        "course_code",
        F.coalesce("semester", blank).alias("semester"),
        body.alias("line"),
    )
    return head.unionByName(rows)


LINE_ORDER = ["student_id", "block", "course_code", "semester", "line"]


def transcript_lines(records: DataFrame) -> DataFrame:
    """Screen layout: title, rule, course name padded to 25, bar, letter."""
    body = F.format_string("%-25s | %s", F.col("course_name"), F.col("letter_grade"))
    return _lines(records, "TRANSCRIPT", F.lit(RULE), body)


def transcript_listing(records: DataFrame) -> DataFrame:
    """Listing layout: title, column names, then code, name, score and letter."""
    score = F.coalesce(F.col("final_score").cast("string"), F.lit("None"))
    body = F.concat_ws(" | ", "course_code", "course_name", score, "letter_grade")
    return _lines(records, "Official Transcript", F.lit(LISTING_HEADER), body)


# -- SQL names --------------------------------------------------------------


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views of the tables and the derived ones, for callers who write SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    t = tables
    transcripts(t["students"], t["courses"], t["enrollments"], t["grades"]).createOrReplaceTempView(
        "student_transcripts_view"
    )
    attendance_stats(t["attendance"], t["enrollments"]).createOrReplaceTempView("attendance_stats_view")


__all__ = [
    "activity_log",
    "at_risk",
    "attendance_pct",
    "attendance_stats",
    "course_performance",
    "deans_list",
    "deans_list_by_course",
    "enrollment_counts",
    "enrollment_means",
    "pg_order",
    "register_views",
    "tiered_mean",
    "top_mean",
    "transcript_lines",
    "transcript_listing",
    "transcripts",
    "transcripts_for",
]
