"""Any page of the grades x attendance listing, without making the listing.

Two left joins from an enrollment to its m grades and n attendance rows give
max(m, 1) x max(n, 1) rows.  In the declared order (enrollment, then grade, then
attendance row) the rows of an enrollment are one stretch of row numbers, so its
start is a prefix sum of sizes, and row k of the stretch is grade k div n with
attendance row k mod n.  Only the enrollments that a page touches are met with
their grades and days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.operators.keys import assign_ids
from rollbook.operators.lookup import with_match

_KEY = "enrollment_id"


def starts(rows: DataFrame, key: str, size: Column) -> DataFrame:
    """Rows with ``start``, the sum of the sizes of the rows before them by ``key``, and ``size``.

    Rows are range-partitioned and written; sums run within a partition and over
    the totals of the partitions before it, one number each.
    """
    sorted_rows = rows.withColumn("size", size).repartitionByRange(key).sortWithinPartitions(key)
    written = stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    totals = written.groupBy("_part").agg(F.sum("size").alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = written.withColumn("_within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    placed = summed.join(totals, "_part").withColumn("start", F.col("_before") + F.col("_within"))
    return placed.drop("_at", "_part", "_before", "_within")


def _numbered(rows: DataFrame, hits: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows of the enrollments hit, numbered from 0 within each by ``order``.

    The numbers come from one range-partitioned sort, so an enrollment with very
    many rows is spread like others.
    """
    theirs = with_match(rows, hits, [_KEY])
    ids = stage(assign_ids(theirs, "_id", 0, [_KEY, *order]))
    firsts = ids.groupBy(_KEY).agg(F.min("_id").alias("_first"))
    return ids.join(firsts, _KEY).withColumn(name, F.col("_id") - F.col("_first")).drop("_id", "_first")


def activity_page(
    students: DataFrame,
    courses: DataFrame,
    enrollments: DataFrame,
    grades: DataFrame,
    attendance: DataFrame,
    first: int,
    last: int,
) -> DataFrame:
    """Rows ``first`` to ``last`` - 1 of the listing, counted from 0.

    The order is by enrollment, then assessment and score, then date and status,
    NULL first.  Work beyond the sizes of all enrollments goes with the page.
    """
    named = enrollments.select(_KEY, "student_id", "course_id")
    named = named.join(students.select("student_id", "first_name", "last_name"), "student_id")
    named = named.join(courses.select("course_id", "course_code"), "course_id")
    for rows, name in ((grades, "m"), (attendance, "n")):
        named = named.join(rows.groupBy(_KEY).agg(F.count(F.lit(1)).alias(name)), _KEY, "left")
    one_or = lambda name: F.greatest(F.coalesce(name, F.lit(0)), F.lit(1))
    named = named.select(_KEY, "first_name", "last_name", "course_code", one_or("m").alias("m"), one_or("n").alias("n"))
    placed = starts(named, _KEY, F.col("m") * F.col("n"))
    hits = stage(placed.where((F.col("start") < last) & (F.col("start") + F.col("size") > first)))
    low = F.greatest(F.lit(first), F.col("start"))
    high = F.least(F.lit(last), F.col("start") + F.col("size"))
    rows = hits.withColumn("row", F.explode(F.sequence(low, high - 1)))
    inside = F.col("row") - F.col("start")
    rows = rows.withColumns({"_grade": F.call_function("div", inside, F.col("n")), "_day": inside % F.col("n")})
    marks = _numbered(grades.select(_KEY, "assessment_type", "score"), hits, ["assessment_type", "score"], "_grade")
    days = _numbered(attendance.select(_KEY, "attendance_date", "status"), hits, ["attendance_date", "status"], "_day")
    rows = rows.join(marks, [_KEY, "_grade"], "left").join(days, [_KEY, "_day"], "left")
    return rows.select("row", _KEY, "first_name", "last_name", "course_code", "assessment_type", "score", "status", "attendance_date")
