"""From business keys to ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.joins import all_set, distinct_keys
from rollbook.functions.staging import stage


def with_match(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have a partner in ``other`` (EXISTS)."""
    return rows.join(distinct_keys(other, on), list(on), "left_semi")


def without_match(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have no partner in ``other`` (NOT EXISTS); NULL keys have none."""
    return rows.join(distinct_keys(other, on), list(on), "left_anti")


def find(table: DataFrame, key: str, id_col: str, wanted: DataFrame) -> DataFrame:
    """(key, id) of the wanted keys.  An inner join lets Spark broadcast either side."""
    return table.select(key, id_col).join(distinct_keys(wanted, [key]), key)


def held_keys(table: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted keys that ``table`` holds, each once."""
    return distinct_keys(table.select(*keys).join(distinct_keys(wanted, keys), list(keys), "left_semi"), keys)


def first_enrollments(enrollments: DataFrame, pairs: DataFrame) -> DataFrame:
    """Lowest enrollment_id of each wanted (student_id, course_id)."""
    on = ["student_id", "course_id"]
    rows = enrollments.where(all_set(on)).select("enrollment_id", *on)
    return rows.join(distinct_keys(pairs, on), on, "left_semi").groupBy(*on).agg(
        F.min("enrollment_id").alias("enrollment_id")
    )


def link_pairs(
    commands: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame | None = None,
    student_key: str = "email",
    course_key: str = "course_code",
) -> DataFrame:
    """Ids behind every distinct (student, course) key of the commands.

    Columns: both keys, student_id, course_id and, with ``enrollments``, the
    lowest enrollment_id of the two.  A miss leaves NULL; a NULL key is a miss.
    The result is written, so that all consumers share one lookup and join it
    as a scan; keys and ids are written first, so their size decides how the
    tables are joined.
    """
    pairs = stage(commands.select(student_key, course_key).distinct())
    links = pairs.join(find(courses, course_key, "course_id", pairs), course_key, "left")
    links = stage(links.join(find(students, student_key, "student_id", pairs), student_key, "left"))
    if enrollments is None:
        return links
    return stage(links.join(first_enrollments(enrollments, links), ["student_id", "course_id"], "left"))
