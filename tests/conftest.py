from __future__ import annotations

import datetime as dt
import decimal
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollbook import schemas  # noqa: E402
from rollbook.operators.clean import conform  # noqa: E402
from rollbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        2,
        spark__ui__showConsoleProgress="false",
        # compiling a plan takes longer than running it on a few rows
        spark__sql__codegen__wholeStage="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("staged")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Tables from short row lists; columns left out are NULL."""

    def build(table: str, columns: str, rows: list[tuple]):
        schema = schemas.TABLES[table]
        names = columns.split()
        fields = [schema[n] for n in names]
        df = spark.createDataFrame([tuple(_typed(v) for v in r) for r in rows], type(schema)(fields))
        return conform(df, schema)

    return build


def _typed(value):
    if isinstance(value, float):
        return decimal.Decimal(str(value))
    if isinstance(value, str) and len(value) == 10 and value[4] == value[7] == "-":
        return dt.date.fromisoformat(value)
    return value


@pytest.fixture
def school(make):
    """Two students, two courses, four enrollments, a few grades and days."""
    return {
        "students": make(
            "students",
            "student_id first_name last_name email major",
            [(1, "Ann", "Low", "ann@x", "Math"), (2, "Bob", "High", "bob@x", "Art")],
        ),
        "courses": make(
            "courses",
            "course_id course_name course_code credits",
            [(1, "Algebra", "M1", 3), (2, "Drawing", "A1", 2), (3, "Drawing", "A2", 2)],
        ),
        "enrollments": make(
            "enrollments",
            "enrollment_id student_id course_id semester enrollment_date",
            [
                (10, 1, 1, "Fall 2024", "2024-09-01"),
                (11, 1, 1, "Spring 2025", "2025-02-01"),
                (12, 2, 1, "Fall 2024", "2024-09-01"),
                (13, 2, 2, "Fall 2024", "2024-09-01"),
            ],
        ),
        "grades": make(
            "grades",
            "grade_id enrollment_id assessment_type score weight",
            [
                (100, 10, "Midterm", 80.0, 0.3),
                (101, 10, "Final", 90.0, 0.5),
                (102, 12, "Midterm", 59.99, 0.3),
                (103, 12, "Midterm", 60.0, 0.3),
            ],
        ),
        "attendance": make(
            "attendance",
            "attendance_id enrollment_id attendance_date status",
            [
                (1, 10, "2024-09-02", "Present"),
                (2, 10, "2024-09-03", "Late"),
                (3, 11, "2025-02-02", "Present"),
                (4, 11, "2025-02-03", "Absent"),
                (5, 12, "2024-09-02", "Late"),
                (6, 12, "2024-09-03", "Excused"),
                (7, 12, "2024-09-04", "Excused"),
                (8, 12, "2024-09-05", "Excused"),
            ],
        ),
    }


def rows(df, *columns):
    """Rows as plain tuples, sorted with NULL last."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
