from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.text import derive_email, fit_text
from rollbook.operators import clean, integrity, keys, lookup, patterns
from rollbook.operators import rules as R
from tests.conftest import rows


def texts(spark, *values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_na_tokens_are_missing(spark):
    df = spark.createDataFrame([(1, ""), (2, "NA"), (3, "null"), (4, "N/A"), (5, None), (6, "a@x")], "i int, email string")
    assert rows(clean.drop_missing(df, ["email"])) == [(6, "a@x")]


def test_score_edges(spark):
    df = texts(spark, "-0.01", "0", "100", "100.004", "100.005", "150", "1000", None, "x", name="score")
    valid, rejected = R.apply_rules(df, [R.number("score"), R.in_range("score")])
    assert rows(clean.coerce(valid, schemas.GRADES)) == [(D("0.00"),), (D("100.00"),), (D("100.00"),), (None,)]
    assert {r.score: list(r.reasons) for r in rejected.collect()} == {
        "-0.01": ["score_out_of_range"],
        "100.005": ["score_out_of_range"],
        "150": ["score_out_of_range"],
        "1000": ["score_bad_number"],
        "x": ["score_bad_number"],
    }
    raw, _ = R.apply_rules(df, [R.in_range("score", on="raw")])
    assert "100.004" not in {r.score for r in raw.collect()}


def test_dates(spark):
    df = texts(spark, "9999-99-99", "2024-01-01x", "24-1-1", "2024-02-29", None, name="d")
    _, rejected = R.apply_rules(df, [R.date_shape("d"), R.real_date("d")])
    assert {r.d: list(r.reasons) for r in rejected.collect()} == {
        "9999-99-99": ["d_not_a_date"],
        "2024-01-01x": ["d_not_a_date"],
        "24-1-1": ["d_bad_shape", "d_not_a_date"],
    }


def test_lengths_ignore_trailing_blanks(spark):
    df = texts(spark, "abc  ", "abcd", "abc", "ab c ", None)
    valid, rejected = R.apply_rules(df, [R.max_length("v", 3)])
    assert rows(rejected, "v") == [("ab c ",), ("abcd",)]
    assert rows(valid.select(fit_text("v", 3))) == [("abc",), ("abc",), (None,)]


def test_closed_set_and_positive_let_null_pass(spark):
    df = spark.createDataFrame([("Late", 1), ("late", 0), (None, None)], "status string, credits int")
    _, rejected = R.apply_rules(df, [R.one_of("status"), R.positive("credits")])
    assert rows(rejected, "status", "reasons") == [("late", ["status_not_allowed", "credits_not_positive"])]


def test_table_rules_cover_declared_constraints():
    assert [r.reason for r in R.table_rules("courses", ["course_name", "course_code", "credits"])] == [
        "course_name_missing",
        "course_code_missing",
        "course_name_too_long",
        "course_code_too_long",
        "credits_not_positive",
    ]


def test_defaults_only_when_omitted(spark):
    df = spark.createDataFrame([(1, None)], "i int, d date")
    day = F.lit("2024-06-01").cast("date")
    assert rows(clean.with_defaults(df, {"d": day})) == [(1, None)]
    assert rows(clean.with_defaults(df.drop("d"), {"d": day})) == [(1, dt.date(2024, 6, 1))]


def test_evolve_adds_typed_nulls(spark):
    df = clean.evolve(spark.createDataFrame([(1,)], "student_id long"), schemas.STUDENTS)
    assert dict(df.dtypes)["phone_number"] == "string"
    assert rows(df, "student_id", "phone_number") == [(1, None)]


def test_derive_email(spark):
    df = spark.createDataFrame([("Thabo", "Van Wyk", 7)], "f string, l string, n int")
    assert rows(df.select(derive_email("f", "l", "c.example", "n"))) == [("thabo.vanwyk7@c.example",)]


def test_first_row_of_a_key_wins_and_old_rows_stay(spark, school):
    batch = spark.createDataFrame(
        [("new@x", "B", 2), ("new@x", "A", 1), ("ann@x", "Z", 3), ("New@x", "C", 4)], "email string, first_name string, seq int"
    )
    inserted, skipped = keys.insert_absent(school["students"], batch, ["email"], ["seq"])
    assert rows(inserted) == [("New@x", "C", 4), ("new@x", "A", 1)]
    assert rows(skipped, "seq") == [(2,), (3,)]


def test_null_keys_never_conflict(spark, school):
    batch = spark.createDataFrame(
        [(1, 1, None, 1), (1, 1, None, 2), (1, 1, "Fall 2024", 3), (1, 1, None, 1)],
        "student_id long, course_id long, semester string, seq int",
    )
    inserted, skipped = keys.insert_absent(school["enrollments"], batch, schemas.UNIQUE_KEYS["enrollments"], ["seq"])
    assert rows(inserted, "semester", "seq") == [(None, 1), (None, 1), (None, 2)]
    assert rows(skipped, "seq") == [(3,)]


def test_inserting_again_changes_nothing(spark, school):
    batch = spark.range(100).select(F.concat(F.lit("p"), F.col("id") % 40).alias("email"), F.col("id").alias("seq"))
    target = school["students"].select("email")
    inserted, skipped = keys.insert_absent(target, batch, ["email"], ["seq"])
    assert inserted.count() == 40 and skipped.count() == 60
    again, _ = keys.insert_absent(target.unionByName(inserted.select("email")), batch, ["email"], ["seq"])
    assert again.count() == 0


@pytest.mark.parametrize("order", [None, ["id"]])
def test_ids_are_dense_and_stable(spark, order):
    df = keys.assign_ids(spark.range(0, 1000, 1, 7), "new_id", 50, order)
    first = rows(df)
    assert sorted(r[1] for r in first) == list(range(50, 1050))
    assert rows(df.repartition(3)) == first
    if order:
        assert all(new == old + 50 for old, new in first)


def test_ids_of_nothing(spark):
    assert keys.assign_ids(spark.range(0), "new_id", 1).count() == 0
    assert keys.next_id(spark.range(0), "id") == 1


def test_orphans_and_duplicates(make, school):
    grades = make(
        "grades", "grade_id enrollment_id assessment_type", [(1, 10, "a"), (2, 99, "a"), (3, None, "a"), (4, 99, "a"), (5, None, "a")]
    )
    lost = integrity.orphans(grades, school["enrollments"], "enrollment_id", "enrollment_id")
    assert rows(lost, "grade_id") == [(2,), (4,)]
    count = integrity.orphan_count(grades, school["enrollments"], "enrollment_id", "enrollment_id")
    assert rows(count) == [(5, 2)]
    assert rows(integrity.duplicate_keys(grades, ["enrollment_id", "assessment_type"])) == [(99, "a", 2)]


def test_cascade_leaves_no_orphans(spark, school):
    kept, deleted = integrity.cascade_delete(school, "students", spark.createDataFrame([(1,)], "student_id long"))
    assert rows(kept["students"], "student_id") == [(2,)]
    assert rows(kept["enrollments"], "enrollment_id") == [(12,), (13,)]
    assert {n: df.count() for n, df in deleted.items()} == {"students": 1, "enrollments": 2, "grades": 2, "attendance": 4}
    for child, fk, parent, pk in schemas.FOREIGN_KEYS:
        assert integrity.orphans(kept[child], kept[parent], fk, pk).count() == 0
    assert kept["courses"].count() == 3


def test_match_and_no_match(spark, school):
    some = spark.createDataFrame([(10,), (10,), (None,)], "enrollment_id long")
    assert lookup.with_match(school["enrollments"], some, ["enrollment_id"]).count() == 1
    assert lookup.without_match(school["enrollments"], some, ["enrollment_id"]).count() == 3


def test_calendar(spark):
    df = spark.createDataFrame([(1, "2024-03-01")], "i int, start string")
    days = [r.class_date for r in patterns.calendar_spine(df, "start").collect()]
    assert len(days) == 11 and min(days) == dt.date(2024, 3, 1) and all(d.weekday() < 5 for d in days)


def test_sample_is_distinct_seeded_and_bounded(spark):
    groups = spark.range(200).withColumnRenamed("id", "g")
    items = spark.range(100, 107).withColumnRenamed("id", "item")
    first = rows(patterns.sample_per_group(groups, items, "g", "item", 3, 1))
    assert len(first) == len(set(first)) == 600
    assert rows(patterns.sample_per_group(groups, items, "g", "item", 3, 1)) == first
    assert rows(patterns.sample_per_group(groups, items, "g", "item", 3, 2)) != first
    assert {i for _, i in first} == set(range(100, 107))
    assert patterns.sample_per_group(groups, items, "g", "item", 99, 1).count() == 1400
    assert patterns.sample_per_group(groups, items, "g", "item", 0, 1).count() == 0


def test_backfill_only_the_childless(spark, school):
    template = [{"assessment_type": F.lit(a)} for a in ("Midterm", "Final")]
    got = patterns.backfill_children(school["enrollments"], school["grades"], "enrollment_id", template)
    assert rows(got) == [(11, "Final"), (11, "Midterm"), (13, "Final"), (13, "Midterm")]
