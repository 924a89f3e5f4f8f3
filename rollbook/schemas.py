"""Declared shapes of the five academic tables and of the three feeds.

Everything here is data: column types, keys, length limits and closed value
sets.  The operators take these as arguments, so they serve other tables too.
"""

from __future__ import annotations

from pyspark.sql import types as T

SCORE = T.DecimalType(5, 2)
WEIGHT = T.DecimalType(3, 2)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STUDENTS = _table(
    ("student_id", T.LongType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("email", T.StringType()),
    ("date_of_birth", T.DateType()),
    ("major", T.StringType()),
    ("phone_number", T.StringType()),
)
COURSES = _table(
    ("course_id", T.LongType()),
    ("course_name", T.StringType()),
    ("course_code", T.StringType()),
    ("credits", T.IntegerType()),
    ("department", T.StringType()),
)
ENROLLMENTS = _table(
    ("enrollment_id", T.LongType()),
    ("student_id", T.LongType()),
    ("course_id", T.LongType()),
    ("enrollment_date", T.DateType()),
    ("semester", T.StringType()),
)
GRADES = _table(
    ("grade_id", T.LongType()),
    ("enrollment_id", T.LongType()),
    ("assessment_type", T.StringType()),
    ("score", SCORE),
    ("weight", WEIGHT),
)
ATTENDANCE = _table(
    ("attendance_id", T.LongType()),
    ("enrollment_id", T.LongType()),
    ("attendance_date", T.DateType()),
    ("status", T.StringType()),
)

TABLES = {
    "students": STUDENTS,
    "courses": COURSES,
    "enrollments": ENROLLMENTS,
    "grades": GRADES,
    "attendance": ATTENDANCE,
}

PRIMARY_KEYS = {
    "students": "student_id",
    "courses": "course_id",
    "enrollments": "enrollment_id",
    "grades": "grade_id",
    "attendance": "attendance_id",
}

UNIQUE_KEYS = {
    "students": ["email"],
    "courses": ["course_code"],
    "enrollments": ["student_id", "course_id", "semester"],
}

# (child, child column, parent, parent column); a parent precedes its children.
FOREIGN_KEYS = [
    ("enrollments", "student_id", "students", "student_id"),
    ("enrollments", "course_id", "courses", "course_id"),
    ("grades", "enrollment_id", "enrollments", "enrollment_id"),
    ("attendance", "enrollment_id", "enrollments", "enrollment_id"),
]

REQUIRED = {
    "students": ["first_name", "last_name", "email"],
    "courses": ["course_name", "course_code"],
    "enrollments": [],
    "grades": ["assessment_type"],
    "attendance": [],
}

MAX_LENGTH = {
    "students": {"first_name": 50, "last_name": 50, "email": 100, "major": 50, "phone_number": 15},
    "courses": {"course_name": 100, "course_code": 20, "department": 50},
    "enrollments": {"semester": 20},
    "grades": {"assessment_type": 50},
    "attendance": {"status": 20},
}

# Sort columns of stored files: row-group statistics then prune the lookups
# that an index would serve (by name, by student, by enrollment, by date).
CLUSTER_BY = {
    "students": ["last_name", "student_id"],
    "courses": ["course_id"],
    "enrollments": ["student_id", "course_id", "enrollment_id"],
    "grades": ["enrollment_id", "grade_id"],
    "attendance": ["attendance_date", "attendance_id"],
}

# Fixed values that decide results.
STATUSES = ("Present", "Absent", "Late", "Excused")
ATTENDED = ("Present", "Late")
TIERS = ((90, "Excellent"), (75, "Good"), (60, "Average"))
TIER_OTHERWISE = "Needs Improvement"
LETTERS = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
LETTER_OTHERWISE = "F"
LETTER_MISSING = "N/A"
FEED_SEMESTER = "External Transfer"

# Two rows every installation starts with.
SEED_STUDENTS = [("John", "Doe", "john.doe@example.com", "Computer Science")]
SEED_COURSES = [("Intro to Data Engineering", "DE101", 3)]

PEOPLE_FEED = _table(
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("email", T.StringType()),
    ("dob", T.StringType()),
    ("major", T.StringType()),
)
CATALOG_FEED = _table(
    ("course_name", T.StringType()),
    ("course_code", T.StringType()),
    ("credits", T.StringType()),
)
GRADE_FEED = _table(
    ("student_ref_id", T.LongType()),
    ("course_code_ref", T.StringType()),
    ("assessment", T.StringType()),
    ("score", T.StringType()),
    ("weight", T.StringType()),
)

COMMANDS = {
    "add_students": _table(
        ("seq", T.LongType()),
        ("first_name", T.StringType()),
        ("last_name", T.StringType()),
        ("email", T.StringType()),
        ("dob", T.StringType()),
        ("major", T.StringType()),
    ),
    "register_students": _table(
        ("seq", T.LongType()),
        ("email", T.StringType()),
        ("course_code", T.StringType()),
        ("semester", T.StringType()),
    ),
    "record_grades": _table(
        ("seq", T.LongType()),
        ("email", T.StringType()),
        ("course_code", T.StringType()),
        ("assessment", T.StringType()),
        ("score", T.StringType()),
        ("weight", T.StringType()),
    ),
    "mark_attendance": _table(
        ("seq", T.LongType()),
        ("email", T.StringType()),
        ("course_code", T.StringType()),
        ("status", T.StringType()),
    ),
}
