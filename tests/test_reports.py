from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rollbook.functions.exact import mean_units, merge_parts, mean_parts
from rollbook.plans import reports as A
from tests.conftest import rows


def scores(spark, *pairs):
    """One key with each score repeated n times."""
    parts = [
        spark.range(n).select(F.lit(1).alias("k"), F.lit(s).cast("decimal(5,2)").alias("score")) for s, n in pairs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def test_tier_uses_unrounded_mean(spark):
    fact = scores(spark, ("90.00", 29_999), ("89.99", 1))
    assert rows(A.tiered_mean(fact, ["k"])) == [(1, D("90.00"), "Good")]


def test_mean_is_rounded_once(spark):
    fact = scores(spark, ("84.99", 300_001), ("85.00", 300_000))
    assert rows(A.tiered_mean(fact, ["k"]), "average_score") == [(D("84.99"),)]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_mean_ignores_partitioning(spark, parts):
    fact = scores(spark, ("33.33", 7), ("66.67", 5), ("0.01", 1)).repartition(parts)
    halves = fact.withColumn("h", F.col("score") > 50).groupBy("k", "h").agg(*mean_parts("score"))
    merged = halves.groupBy("k").agg(*merge_parts()).select(mean_units().alias("m"))
    assert merged.first()["m"] == 4359  # (7 * 3333 + 5 * 6667 + 1) / 13


def test_negative_mean_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(-5, 2), (5, 2), (-7, 3)], "_sum_units long, _n long")
    assert [r[0] for r in df.select(mean_units()).collect()] == [-3, 3, -2]


def test_all_scores_null(make, school):
    grades = make("grades", "grade_id enrollment_id assessment_type score", [(1, 10, "Final", None)])
    report = A.course_performance(school["courses"], school["enrollments"], grades)
    assert rows(report) == [("M1", "Algebra", 1, None, "Needs Improvement")]
    t = A.transcripts(school["students"], school["courses"], school["enrollments"], grades)
    assert {r.letter_grade for r in t.collect()} == {"N/A"}


def test_null_mean_comes_first_on_descending_order(make, school):
    grades = make(
        "grades", "grade_id enrollment_id assessment_type score", [(1, 10, "Final", 95.0), (2, 13, "Final", None)]
    )
    report = A.course_performance(school["courses"], school["enrollments"], grades)
    assert [r.course_code for r in report.collect()] == ["A1", "M1"]


def test_transcripts(school):
    t = A.transcripts(*[school[n] for n in ("students", "courses", "enrollments", "grades")])
    assert rows(t, "student_id", "course_code", "semester", "final_score", "letter_grade") == [
        (1, "M1", "Fall 2024", D("85.00"), "B"),
        (1, "M1", "Spring 2025", None, "N/A"),
        (2, "A1", "Fall 2024", None, "N/A"),
        # mean 59.995: shown as 60.00, still below the floor of D
        (2, "M1", "Fall 2024", D("60.00"), "F"),
    ]


def test_transcripts_merge_null_semesters(make, school):
    enrollments = make("enrollments", "enrollment_id student_id course_id", [(1, 1, 1), (2, 1, 1), (3, None, 1)])
    grades = make("grades", "grade_id enrollment_id assessment_type score", [(1, 1, "a", 70.0), (2, 2, "a", 80.0)])
    t = A.transcripts(school["students"], school["courses"], enrollments, grades)
    assert rows(t, "student_id", "semester", "final_score") == [(1, None, D("75.00"))]


def test_transcripts_for_requests(spark, school):
    asked = spark.createDataFrame([("bob@x",), ("nobody@x",), (None,), ("bob@x",)], "email string")
    four = [school[n] for n in ("students", "courses", "enrollments", "grades")]
    got = A.transcripts_for(*four, asked)
    assert rows(got) == rows(A.transcripts(*four).where("email = 'bob@x'"))


def test_attendance(school):
    stats = A.attendance_stats(school["attendance"], school["enrollments"])
    # both semesters of student 1 together: 3 of 4
    assert rows(stats) == [(1, 1, 4, 3), (2, 1, 4, 1)]
    risk = A.at_risk(stats, school["students"], school["courses"])
    assert rows(risk) == [("Bob", "High", "M1", 1, 4, D("25.0"))]


def test_attendance_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (2, 3), (0, 5)], "classes_attended long, total_classes long")
    got = [r[0] for r in df.select(A.attendance_pct()).collect()]
    assert got == [D("12.5"), D("6.3"), D("66.7"), D("0.0")]


def test_deans_list_needs_three_scores(make, school):
    grades = make(
        "grades",
        "grade_id enrollment_id assessment_type score",
        [(1, 10, "a", 90.0), (2, 11, "a", 91.0), (3, 10, "b", None), (4, 12, "a", 50.0), (5, 12, "b", 50.0), (6, 13, "a", 51.0)],
    )
    got = A.deans_list(school["students"], school["enrollments"], grades)
    assert rows(got) == [(2, "Bob", "High", "Art", D("50.33"))]


def test_top_mean_breaks_ties_by_key(spark):
    fact = spark.createDataFrame([(k, "80") for k in (3, 1, 2) for _ in range(3)], "k int, s string").select(
        "k", F.col("s").cast("decimal(5,2)").alias("score")
    )
    assert [r.k for r in A.top_mean(fact, ["k"], k=2).collect()] == [1, 2]


def test_deans_list_by_course_averages_finals(make, school):
    enrollments = make(
        "enrollments",
        "enrollment_id student_id course_id semester",
        [(i, 1, 1 + i % 3, f"S{i}") for i in range(4)] + [(9, 2, 1, "S1")],
    )
    grades = make(
        "grades",
        "grade_id enrollment_id assessment_type score",
        [(i, i, "a", s) for i, s in enumerate([70.0, 80.0, 90.0, 100.0])] + [(9, 0, "b", 71.0)],
    )
    got = A.deans_list_by_course(school["students"], school["courses"], enrollments, grades)
    assert rows(got) == [(1, "Ann", "Low", D("85.13"))]


def test_popularity_keeps_unused_courses_and_merges_names(school):
    got = A.enrollment_counts(school["courses"], school["enrollments"])
    assert rows(got, "course_name", "semester", "total_students") == [
        ("Algebra", "Fall 2024", 2),
        ("Algebra", "Spring 2025", 1),
        ("Drawing", "Fall 2024", 1),
        ("Drawing", None, 0),
    ]


def test_activity_log_gives_the_multiplicities_of_the_listing(spark, school):
    five = [school[n] for n in ("students", "courses", "enrollments", "grades", "attendance")]
    log = A.activity_log(*five)
    wide = (
        school["enrollments"]
        .join(school["students"].select("student_id", "first_name"), "student_id")
        .join(school["grades"].select("enrollment_id", "assessment_type", "score"), "enrollment_id", "left")
        .join(school["attendance"].select("enrollment_id", "status", "attendance_date"), "enrollment_id", "left")
    )
    for kind, cols in (("grade", ["assessment_type", "score"]), ("attendance", ["status", "attendance_date"])):
        name = ["first_name", *cols]
        from_pairs = wide.where(F.col(cols[0]).isNotNull()).groupBy(*name).count()
        from_log = log.where(F.col("kind") == kind).groupBy(*name).agg(F.sum("times").alias("count"))
        assert rows(from_pairs) == rows(from_log)
    assert rows(log.where("kind = 'none'"), "first_name", "course_code", "times") == [("Bob", "A1", 1)]
    asked = spark.createDataFrame([("bob@x", "A1"), ("ann@x", "M1"), (None, "M1"), ("no@x", "M1")], "email string, course_code string")
    some = A.activity_log(*five, requests=asked)
    assert rows(some) == rows(log.where("first_name = 'Ann' or course_code = 'A1'"))


def test_text_lines(school):
    t = A.transcripts(*[school[n] for n in ("students", "courses", "enrollments", "grades")])
    lines = [r.line for r in A.transcript_lines(t).where("student_id = 1").orderBy(*A.LINE_ORDER).collect()]
    assert lines == [
        "TRANSCRIPT: Ann Low",
        "-" * 40,
        "Algebra                   | B",
        "Algebra                   | N/A",
    ]
    listing = [r.line for r in A.transcript_listing(t).where("student_id = 2").orderBy(*A.LINE_ORDER).collect()]
    assert listing == [
        "Official Transcript: Bob High",
        "Course Code | Course Name | Score | Grade",
        "A1 | Drawing | None | N/A",
        "M1 | Algebra | 60.00 | F",
    ]


def test_long_names_are_not_cut(make, school):
    courses = make("courses", "course_id course_name course_code", [(1, "A course with a name of forty-one letters", "M1")])
    t = A.transcripts(school["students"], courses, school["enrollments"], school["grades"])
    lines = [r.line for r in A.transcript_lines(t).where("block = 2").collect()]
    assert "A course with a name of forty-one letters | B" in lines


def test_sql_names(spark, school):
    A.register_views(school)
    got = spark.sql("SELECT letter_grade FROM student_transcripts_view WHERE email = 'ann@x' AND semester = 'Fall 2024'")
    assert rows(got) == [("B",)]
    low = spark.sql("SELECT student_id FROM attendance_stats_view WHERE classes_attended / total_classes < 0.75")
    assert rows(low) == [(2,)]
