"""Record-keeping commands as batch jobs.

A verb that once took one row per call takes a frame with one row per call.
The order columns (``seq`` by default) stand for the order of the calls and
must tell any two of them apart.  Every verb returns an ``Outcome``; commands
it refuses come back with their reasons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.joins import all_set, null_safe_left
from rollbook.functions.staging import stage
from rollbook.operators import rules as R
from rollbook.operators.clean import coerce, conform, fit_lengths, with_defaults
from rollbook.operators.integrity import cascade_delete
from rollbook.operators.keys import assign_ids, first_wins, insert_absent, last_wins, next_id
from rollbook.operators.lookup import find, held_keys, link_pairs, without_match
from rollbook.sources.feeds import ABSENT, ORDER

Tables = Mapping[str, DataFrame]
# First free id per table.  Without it the highest id in use is looked up.
NextIds = Mapping[str, int] | None
_PAIR = ["email", "course_code"]


@dataclass(frozen=True)
class Outcome:
    """What a verb did.

    ``tables``   all tables, the changed ones replaced
    ``added``    rows new in each table (an append need not rewrite the rest)
    ``rejected`` refused commands with ``reasons``
    ``changed``  tables whose old rows changed or left
    """

    tables: dict[str, DataFrame]
    added: dict[str, DataFrame]
    rejected: DataFrame
    changed: tuple[str, ...] = ()

    def counters(self) -> DataFrame:
        """Rows (metric, rows): added per table, rejected per reason."""
        out = self.rejected.select(F.explode("reasons").alias("metric"))
        for name, df in self.added.items():
            out = out.unionAll(df.select(F.lit(f"added_{name}").alias("metric")))
        return out.groupBy("metric").agg(F.count(F.lit(1)).alias("rows"))


def _today(as_of: Column | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of


def _with_ids(
    tables: Tables, table: str, rows: DataFrame, order: Sequence[str] | None, next_ids: NextIds
) -> DataFrame:
    """The rows with ids given and declared columns only."""
    pk = schemas.PRIMARY_KEYS[table]
    start = next_ids[table] if next_ids else next_id(tables[table], pk)
    return conform(assign_ids(rows, pk, start, order), schemas.TABLES[table])


def _grown(tables: Tables, table: str, added: DataFrame) -> DataFrame:
    return conform(tables[table], schemas.TABLES[table]).unionByName(added)


def _reason(test: Column, reason: str) -> R.Rule:
    """A failed lookup as a rule: broken where ``test`` is true."""
    return R.Rule(reason, ~test)


def _judge(
    rows: DataFrame, columns: Sequence[str], *stages: Sequence[R.Rule], told: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) under stages of rules, the first broken stage giving the reasons.

    The rows are judged and written once; both parts read them back.  Columns
    that only the rejected part needs (``told``) are written for it alone.
    """
    good = F.size(R.REASONS) == 0
    judged = rows.withColumn(R.REASONS, R.judged(*stages)).withColumns({c: F.when(~good, F.col(c)) for c in told})
    judged = stage(judged)
    return judged.where(good).drop(R.REASONS, *told), judged.where(~good).select(*columns, R.REASONS)


# -- students ---------------------------------------------------------------


def add_students(
    tables: Tables, commands: DataFrame, order: Sequence[str] = ("seq",), next_ids: NextIds = None
) -> Outcome:
    """Create students.  A taken email is an error, also inside the batch."""
    order = list(order)
    columns = ["first_name", "last_name", "email", "major"]
    entry = [R.date_shape("dob")]
    stored = [*R.table_rules("students", columns), R.real_date("dob")]
    valid, rejected = _judge(commands, commands.columns, entry, stored)
    valid = fit_lengths(valid, schemas.MAX_LENGTH["students"])
    inserted, taken = insert_absent(tables["students"], valid, ["email"], order)
    rows = inserted.withColumn("date_of_birth", F.col("dob").try_cast("date"))
    added = _with_ids(tables, "students", rows, order, next_ids)
    taken = taken.select(*commands.columns).withColumn(R.REASONS, F.array(F.lit("duplicate_email")))
    return Outcome(
        {**tables, "students": _grown(tables, "students", added)}, {"students": added}, rejected.unionByName(taken)
    )


def delete_students(tables: Tables, requests: DataFrame) -> Outcome:
    """Delete students by email together with all that refers to them."""
    found = find(tables["students"], "email", "student_id", requests)
    kept, deleted = cascade_delete(tables, "students", found)
    unknown = without_match(requests, found, ["email"]).withColumn(R.REASONS, F.array(F.lit("student_not_found")))
    return Outcome(kept, {}, unknown, tuple(deleted))


# -- enrollments ------------------------------------------------------------


def register_students(
    tables: Tables,
    commands: DataFrame,
    as_of: Column | str | None = None,
    order: Sequence[str] = ("seq",),
    next_ids: NextIds = None,
) -> Outcome:
    """Enroll by email and course code; an enrollment that exists is left alone."""
    order = list(order)
    links = link_pairs(commands, tables["students"], tables["courses"])
    valid, rejected = _judge(
        null_safe_left(commands, links, _PAIR),
        commands.columns,
        [_reason(F.col("student_id").isNull(), "student_not_found")],
        [_reason(F.col("course_id").isNull(), "course_not_found")],
        R.table_rules("enrollments", ["semester"]),
    )
    valid = fit_lengths(valid, schemas.MAX_LENGTH["enrollments"])
    key = schemas.UNIQUE_KEYS["enrollments"]
    batch = stage(valid.select(*dict.fromkeys([*key, *order])))
    inserted, _ = insert_absent(tables["enrollments"], batch, key, order)
    rows = inserted.withColumn("enrollment_date", _today(as_of))
    added = _with_ids(tables, "enrollments", rows, order, next_ids)
    return Outcome(
        {**tables, "enrollments": _grown(tables, "enrollments", added)}, {"enrollments": added}, rejected
    )


def _linked(tables: Tables, commands: DataFrame) -> DataFrame:
    """Commands with the enrollment they mean, the lowest id where there are several."""
    links = link_pairs(commands, tables["students"], tables["courses"], tables["enrollments"])
    return null_safe_left(commands, links.select(*_PAIR, "enrollment_id"), _PAIR)


def _enrolled() -> list[R.Rule]:
    return [_reason(F.col("enrollment_id").isNull(), "enrollment_not_found")]


# -- grades -----------------------------------------------------------------


_GRADE_KEY = ["enrollment_id", "assessment_type"]


def grade_changes(
    tables: Tables, commands: DataFrame, order: Sequence[str] = ("seq",)
) -> tuple[DataFrame, DataFrame]:
    """(winning change per enrollment and assessment, refused commands).

    The last valid command of a key wins.  The changes are written: they are
    used several times.
    """
    order = list(order)
    valid, rejected = _judge(
        _linked(tables, commands),
        commands.columns,
        [R.required("score"), R.number("score", "double"), R.in_range("score", on="raw"), R.number("weight", "double")],
        _enrolled(),
        [
            R.required("assessment"),
            R.max_length("assessment", 50),
            R.number("score"),
            R.number("weight", "decimal(3,2)"),
        ],
    )
    typed = fit_lengths(
        valid.select(
            "enrollment_id",
            F.col("assessment").alias("assessment_type"),
            F.col("score").try_cast(schemas.SCORE).alias("new_score"),
            F.col("weight").try_cast(schemas.WEIGHT).alias("new_weight"),
            F.struct(*order).alias("_order"),
        ),
        schemas.MAX_LENGTH["grades"],
    )
    return stage(last_wins(typed, _GRADE_KEY, ["_order"]).drop("_order")), rejected


def apply_changes(grades: DataFrame, changes: DataFrame, next_ids: NextIds = None) -> tuple[DataFrame, DataFrame]:
    """(old rows brought up to date, rows to add).

    All rows of a key take the change, a NULL weight included.
    """
    old = conform(grades, schemas.GRADES)
    news = changes.withColumn("_hit", F.lit(True))
    update = old.join(news, _GRADE_KEY, "left")
    hit = F.col("_hit").isNotNull()
    updated = update.withColumns(
        {
            "score": F.when(hit, F.col("new_score")).otherwise(F.col("score")),
            "weight": F.when(hit, F.col("new_weight")).otherwise(F.col("weight")),
        }
    ).select(*old.columns)
    return updated, new_grades(old, changes, next_ids)


def new_grades(grades: DataFrame, changes: DataFrame, next_ids: NextIds = None) -> DataFrame:
    """Rows to add: the changes whose key no grade has."""
    fresh = changes.join(held_keys(grades, changes, _GRADE_KEY), _GRADE_KEY, "left_anti").select(
        *_GRADE_KEY, F.col("new_score").alias("score"), F.col("new_weight").alias("weight")
    )
    return _with_ids({"grades": grades}, "grades", fresh, None, next_ids)


def record_grades(
    tables: Tables, commands: DataFrame, order: Sequence[str] = ("seq",), next_ids: NextIds = None
) -> Outcome:
    """Set the grade of (enrollment, assessment): update all its rows, else insert one."""
    changes, rejected = grade_changes(tables, commands, order)
    updated, added = apply_changes(tables["grades"], changes, next_ids)
    return Outcome(
        {**tables, "grades": updated.unionByName(added)}, {"grades": added}, rejected, ("grades",)
    )


# -- attendance -------------------------------------------------------------


def mark_attendance(
    tables: Tables,
    commands: DataFrame,
    as_of: Column | str | None = None,
    order: Sequence[str] = ("seq",),
    next_ids: NextIds = None,
) -> Outcome:
    """Append attendance rows; repeated marks stay.

    The date is today only where the commands carry no ``attendance_date``
    column; a NULL in that column is stored as it is.
    """
    order = list(order)
    valid, rejected = _judge(_linked(tables, commands), commands.columns, [R.one_of("status")], _enrolled())
    dated = with_defaults(valid, {"attendance_date": _today(as_of)})
    rows = dated.select(*dict.fromkeys(["enrollment_id", "attendance_date", "status", *order]))
    added = _with_ids(tables, "attendance", rows, order, next_ids)
    return Outcome({**tables, "attendance": _grown(tables, "attendance", added)}, {"attendance": added}, rejected)


# -- grade feed -------------------------------------------------------------


def _lacks(key: str) -> R.Rule:
    return _reason(F.array_contains(ABSENT, key), f"{key}_absent")


def load_grades(
    tables: Tables,
    feed: DataFrame,
    as_of: Column | str | None = None,
    strict: bool = True,
    dedupe_on: Sequence[str] | None = None,
    next_ids: NextIds = None,
) -> Outcome:
    """Append a feed of grades that names students by id and courses by code.

    Rows of unknown students, else of unknown courses, are skipped with that
    reason.  A pair that is not enrolled gets one enrollment of the feed's own
    semester.  Loading a feed twice doubles its grades unless ``dedupe_on``
    names the grade columns that must not repeat.  With ``strict`` a value the
    grade table cannot hold fails the whole load, otherwise it is set aside.
    """
    pair = ["student_ref_id", "course_code_ref"]
    students = tables["students"].select(F.col("student_id").alias(pair[0]), "student_id")
    courses = tables["courses"].select(F.col("course_code").alias(pair[1]), "course_id")
    links = link_pairs(feed, students, courses, tables["enrollments"], *pair)

    known = all_set(["student_id", "course_id"])
    missing = (
        links.where(known & F.col("enrollment_id").isNull())
        .select("student_id", "course_id")
        .withColumn("semester", F.lit(schemas.FEED_SEMESTER))
        .withColumn("enrollment_date", _today(as_of))
    )
    opened = _with_ids(tables, "enrollments", missing, ["student_id", "course_id"], next_ids)
    made = opened.select("student_id", "course_id", F.col("enrollment_id").alias("_made"))
    links = links.join(made, ["student_id", "course_id"], "left").select(
        *pair, "student_id", "course_id", F.coalesce("enrollment_id", "_made").alias("enrollment_id")
    )

    linked = null_safe_left(feed, links, pair)
    # A key that is missing altogether is an error; the references come first.
    named = [_lacks(c) for c in pair if ABSENT in feed.columns]
    found = [
        [_reason(F.col("student_id").isNull(), "student_not_found")],
        [_reason(F.col("course_id").isNull(), "course_not_found")],
    ]
    stored = [
        *[_lacks(c) for c in ("assessment", "score", "weight") if ABSENT in feed.columns],
        R.required("assessment"),
        R.max_length("assessment", 50),
        R.number("score"),
        R.in_range("score"),
        R.number("weight", "decimal(3,2)"),
    ]
    # the ids of a valid row are in its enrollment
    valid, rejected = _judge(linked, feed.columns, named, *found, stored, told=[*pair, "student_id", "course_id"])
    if strict:
        skipped = F.array(F.lit("student_not_found"), F.lit("course_not_found"))
        refused = rejected.where(~F.arrays_overlap(F.col(R.REASONS), skipped))
        first = refused.select(F.array_join(R.REASONS, ",").alias("why")).first()
        if first is not None:
            raise ValueError(f"grade feed refused: {first['why']}")
    place = [ORDER] if ORDER in feed.columns else []
    rows = fit_lengths(
        coerce(valid.withColumnRenamed("assessment", "assessment_type"), schemas.GRADES).select(
            "enrollment_id", "assessment_type", "score", "weight", *place
        ),
        schemas.MAX_LENGTH["grades"],
    )
    if dedupe_on:
        key = list(dedupe_on)
        rows = stage(first_wins(rows, key, place))
        rows = rows.join(held_keys(tables["grades"], rows, key), key, "left_anti")
    rows = rows.drop(*place)
    added = _with_ids(tables, "grades", rows, None, next_ids)
    return Outcome(
        {
            **tables,
            "enrollments": _grown(tables, "enrollments", opened),
            "grades": _grown(tables, "grades", added),
        },
        {"enrollments": opened, "grades": added},
        rejected,
    )
