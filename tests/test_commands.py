from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from rollbook import schemas
from rollbook.plans import commands as C
from tests.conftest import rows

GRADE = "seq int, email string, course_code string, assessment string, score string, weight string"


@pytest.fixture(params=["small", "large"], autouse=True)
def planned_joins(request, spark):
    """Run every case with joins broadcast and with joins shuffled, as the planner would choose by size."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if request.param == "large":
        for key in keys:
            spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_add_students(spark, school):
    calls = spark.createDataFrame(
        [
            (1, "Cid", "New", "cid@x", "2000-01-31", "Art"),
            (2, "Cid", "Twin", "cid@x", "2000-01-31", "Art"),
            (3, "Ann", "Low", "ann@x", "2000-01-31", "Art"),
            (4, "Dan", "Bad", "dan@x", "9999-99-99", "Art"),
            (5, "Dan", "Good", "dan@x", "2000-02-29", "Art"),
            (6, "Eve", "Short", "eve@x", "24-1-1", "Art"),
            (7, "Fay", None, None, "2000-01-01", None),
        ],
        "seq int, first_name string, last_name string, email string, dob string, major string",
    )
    done = C.add_students(school, calls)
    assert rows(done.added["students"], "student_id", "email", "last_name", "date_of_birth") == [
        (3, "cid@x", "New", dt.date(2000, 1, 31)),
        (4, "dan@x", "Good", dt.date(2000, 2, 29)),
    ]
    assert done.tables["students"].count() == 4
    assert rows(done.rejected, "seq", "reasons") == [
        (2, ["duplicate_email"]),
        (3, ["duplicate_email"]),
        (4, ["dob_not_a_date"]),
        (6, ["dob_bad_shape"]),
        (7, ["last_name_missing", "email_missing"]),
    ]
    counts = {r["metric"]: r["rows"] for r in done.counters().collect()}
    assert counts["added_students"] == 2 and counts["duplicate_email"] == 2


def test_register(spark, school):
    calls = spark.createDataFrame(
        [
            (1, "ann@x", "A1", "Fall 2024"),
            (2, "ann@x", "A1", "Fall 2024"),
            (3, "ann@x", "M1", "Fall 2024"),
            (4, "who@x", "Z9", "Fall 2024"),
            (5, "bob@x", "Z9", "Fall 2024"),
            (6, None, "M1", "Fall 2024"),
            (7, "bob@x", None, "Fall 2024"),
            (8, "bob@x", "A2", None),
            (9, "bob@x", "A2", None),
            (10, "bob@x", "A2", "a semester with a long name"),
        ],
        "seq int, email string, course_code string, semester string",
    )
    done = C.register_students(school, calls, "2024-06-01")
    assert rows(done.added["enrollments"], "enrollment_id", "student_id", "course_id", "semester") == [
        (14, 1, 2, "Fall 2024"),
        (15, 2, 3, None),
        (16, 2, 3, None),
    ]
    assert done.added["enrollments"].first()["enrollment_date"] == dt.date(2024, 6, 1)
    assert rows(done.rejected, "seq", "reasons") == [
        (10, ["semester_too_long"]),
        (4, ["student_not_found"]),
        (5, ["course_not_found"]),
        (6, ["student_not_found"]),
        (7, ["course_not_found"]),
    ]


def test_record_grades(spark, school):
    calls = spark.createDataFrame(
        [
            (1, "bob@x", "M1", "Midterm", "75", None),  # two rows of this key, both change
            (2, "ann@x", "M1", "Project", "10", "0.1"),
            (3, "ann@x", "M1", "Project", "88.125", "0.2"),  # the later command of the key
            (4, "ann@x", "M1", "Final", "100.004", "0.5"),  # raw number above the range
            (5, "ann@x", "M1", "Final", "nan", "0.5"),
            (6, "ann@x", "M1", "Final", "x", "y"),
            (7, "ann@x", "A1", "Final", "50", "0.5"),
            (8, "ann@x", "M1", None, "50", "0.5"),
            (9, "ann@x", "M1", "Final", "50", "10"),
        ],
        GRADE,
    )
    done = C.record_grades(school, calls)
    assert rows(done.tables["grades"], "grade_id", "enrollment_id", "assessment_type", "score", "weight") == [
        (100, 10, "Midterm", D("80.00"), D("0.30")),
        (101, 10, "Final", D("90.00"), D("0.50")),
        (102, 12, "Midterm", D("75.00"), None),
        (103, 12, "Midterm", D("75.00"), None),
        # student 1 is enrolled twice: the lowest enrollment takes the grade
        (104, 10, "Project", D("88.13"), D("0.20")),
    ]
    assert rows(done.rejected, "seq", "reasons") == [
        (4, ["score_out_of_range"]),
        (5, ["score_out_of_range"]),
        (6, ["score_bad_number", "weight_bad_number"]),
        (7, ["enrollment_not_found"]),
        (8, ["assessment_missing"]),
        (9, ["weight_bad_number"]),
    ]


def test_mark_attendance(spark, school):
    calls = spark.createDataFrame(
        [(1, "ann@x", "M1", "Late"), (2, "ann@x", "M1", "Late"), (3, "ann@x", "M1", "Here"), (4, "ann@x", "A2", "Late")],
        "seq int, email string, course_code string, status string",
    )
    done = C.mark_attendance(school, calls, "2024-06-01")
    day = dt.date(2024, 6, 1)
    assert rows(done.added["attendance"]) == [(10, 10, day, "Late"), (9, 10, day, "Late")]
    assert rows(done.rejected, "seq", "reasons") == [(3, ["status_not_allowed"]), (4, ["enrollment_not_found"])]
    dated = calls.selectExpr("*", "cast(null as date) AS attendance_date")
    assert rows(C.mark_attendance(school, dated).added["attendance"], "attendance_date") == [(None,), (None,)]


def test_delete_students(spark, school):
    asked = spark.createDataFrame([("ann@x",), ("who@x",), (None,)], "email string")
    done = C.delete_students(school, asked)
    assert rows(done.tables["grades"], "grade_id") == [(102,), (103,)]
    assert rows(done.rejected) == [("who@x", ["student_not_found"]), (None, ["student_not_found"])]
    assert set(done.changed) == {"students", "enrollments", "grades", "attendance"}


FEED = "student_ref_id long, course_code_ref string, assessment string, score string, weight string"


def test_grade_feed(spark, school):
    feed = spark.createDataFrame(
        [
            (1, "M1", "Final Project", "70.5", "0.4"),
            (1, "A2", "Final Project", "71", "0.4"),
            (1, "A2", "Other", "72", "0.4"),
            (9, "Z9", "Final Project", "73", "0.4"),
            (2, "Z9", "Final Project", "74", "0.4"),
            (2, None, "Final Project", "75", "0.4"),
        ],
        FEED,
    )
    done = C.load_grades(school, feed, "2024-06-01")
    opened = done.added["enrollments"]
    assert rows(opened) == [(14, 1, 3, dt.date(2024, 6, 1), "External Transfer")]
    assert rows(done.added["grades"], "enrollment_id", "assessment_type", "score") == [
        (10, "Final Project", D("70.50")),
        (14, "Final Project", D("71.00")),
        (14, "Other", D("72.00")),
    ]
    assert rows(done.rejected, "score", "reasons") == [
        ("73", ["student_not_found"]),
        ("74", ["course_not_found"]),
        ("75", ["course_not_found"]),
    ]
    twice = C.load_grades(done.tables, feed, "2024-06-01")
    assert twice.added["enrollments"].count() == 0 and twice.added["grades"].count() == 3
    key = ["enrollment_id", "assessment_type"]
    assert C.load_grades(done.tables, feed, "2024-06-01", dedupe_on=key).added["grades"].count() == 0


def test_grade_feed_strict_or_set_aside(spark, school):
    feed = spark.createDataFrame([(1, "M1", "F", "150", "0.4"), (1, "M1", "F", "50", "0.4"), (9, "M1", "F", "x", "0")], FEED)
    with pytest.raises(ValueError, match="score_out_of_range"):
        C.load_grades(school, feed)
    done = C.load_grades(school, feed, strict=False)
    assert done.added["grades"].count() == 1
    assert rows(done.rejected, "score", "reasons") == [("150", ["score_out_of_range"]), ("x", ["student_not_found"])]
    # a bad value of a skipped row does not fail a strict load
    assert C.load_grades(school, feed.where("score != '150'")).added["grades"].count() == 1


def test_scores_that_are_no_plain_numbers_are_refused(spark, school):
    call = ("ann@x", "M1", "Midterm")
    given = ["88d", "88f", "0x1p3", "NaN", None, " 70 ", "7e1"]
    calls = spark.createDataFrame([(i, *call, s, "0.3") for i, s in enumerate(given)], GRADE)
    done = C.record_grades(school, calls)
    assert rows(done.rejected, "seq", "reasons") == [
        (0, ["score_bad_number"]),
        (1, ["score_bad_number"]),
        (2, ["score_bad_number"]),
        (3, ["score_out_of_range"]),
        (4, ["score_missing"]),
    ]
    kept = done.tables["grades"].where("enrollment_id = 10 and assessment_type = 'Midterm'")
    assert rows(kept, "score") == [(D("70.00"),)]


def test_dedupe_keeps_nulls_and_the_first(spark, school):
    feed = spark.createDataFrame(
        [(1, "M1", "Quiz", None, "0.1", 1), (1, "M1", "Quiz", None, "0.1", 2), (1, "M1", "Test", "70", "0.2", 4), (1, "M1", "Test", "70", "0.1", 3)],
        "student_ref_id long, course_code_ref string, assessment string, score string, weight string, feed_order int",
    )
    added = C.load_grades(school, feed, dedupe_on=["enrollment_id", "assessment_type", "score"]).added["grades"]
    assert rows(added, "assessment_type", "score", "weight") == [
        ("Quiz", None, D("0.10")),
        ("Quiz", None, D("0.10")),
        ("Test", D("70.00"), D("0.10")),
    ]


def test_valid_feed_rows_are_written_without_their_keys(spark, school, monkeypatch):
    feed = spark.createDataFrame([(2, "A2", "Final", "70", "0.5"), (9, "A2", "Final", "71", "0.5")], schemas.GRADE_FEED)
    written, write = [], C.stage
    monkeypatch.setattr(C, "stage", lambda df: written.append(write(df)) or written[-1])
    done = C.load_grades(school, feed, "2025-01-01")
    judged = next(df for df in written if "reasons" in df.columns)
    assert rows(judged, "student_ref_id", "course_code_ref") == [(9, "A2"), (None, None)]
    assert rows(done.rejected, "student_ref_id", "course_code_ref", "score") == [(9, "A2", "71")]
    assert done.added["grades"].count() == 1
