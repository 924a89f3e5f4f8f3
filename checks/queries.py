"""The registered queries: each runs a library operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import LINE_ORDER, view, views
from rollbook import schemas
from rollbook.functions.staging import stage, staging_root
from rollbook.functions.text import derive_email
from rollbook.operators import integrity as I
from rollbook.operators import keys as K
from rollbook.operators import patterns as P
from rollbook.operators import rules as R
from rollbook.operators.clean import coerce, conform, evolve, fit_lengths, with_defaults
from rollbook.operators.lookup import with_match
from rollbook.plans import commands as C
from rollbook.plans import incremental as N
from rollbook.plans import late
from rollbook.plans import loads as L
from rollbook.plans import pages
from rollbook.plans import quality as Q
from rollbook.plans import reports as A
from rollbook.sources import exports, feeds
from rollbook.sources.store import TableStore
from rollbook.streaming import ordered
from rollbook.streaming.commands import start_command_stream

AS_OF = "2024-06-01"
SEED = 7
_OUT: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _OUT[fn.__name__] = fn
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_OUT)


def _why() -> Column:
    return F.array_join(R.REASONS, ",").alias("reasons")


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{staging_root(spark)}/{what}-{uuid.uuid4().hex}"


# -- reports ----------------------------------------------------------------


@query
def course_performance(spark: SparkSession, sf: str) -> DataFrame:
    return A.course_performance(*views(spark, sf, "courses", "enrollments", "grades"))


@query
def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return A.transcripts(*views(spark, sf, "students", "courses", "enrollments", "grades"))


@query
def transcripts_for_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts of every student at risk; some requested emails are unknown."""
    students, courses, enrollments, grades, attendance, strangers = views(
        spark, sf, "students", "courses", "enrollments", "grades", "attendance", "strangers"
    )
    low = A.attendance_stats(attendance, enrollments).where("4 * classes_attended < 3 * total_classes")
    asked = with_match(students, low, ["student_id"]).select("email").unionByName(strangers)
    return A.transcripts_for(students, courses, enrollments, grades, asked)


@query
def deans_list(spark: SparkSession, sf: str) -> DataFrame:
    return A.deans_list(*views(spark, sf, "students", "enrollments", "grades"))


@query
def deans_list_by_course(spark: SparkSession, sf: str) -> DataFrame:
    return A.deans_list_by_course(*views(spark, sf, "students", "courses", "enrollments", "grades"))


@query
def attendance_stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.attendance_stats(*views(spark, sf, "attendance", "enrollments"))


@query
def at_risk(spark: SparkSession, sf: str) -> DataFrame:
    attendance, enrollments, students, courses = views(
        spark, sf, "attendance", "enrollments", "students", "courses"
    )
    return A.at_risk(A.attendance_stats(attendance, enrollments), students, courses)


@query
def popularity(spark: SparkSession, sf: str) -> DataFrame:
    return A.enrollment_counts(*views(spark, sf, "courses", "enrollments"))


@query
def activity_log(spark: SparkSession, sf: str) -> DataFrame:
    return A.activity_log(*views(spark, sf, "students", "courses", "enrollments", "grades", "attendance"))


@query
def activity_page(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 1,000 to 3,999 of the grades x attendance listing."""
    five = views(spark, sf, "students", "courses", "enrollments", "grades", "attendance")
    return pages.activity_page(*five, 1000, 4000)


@query
def transcript_text(spark: SparkSession, sf: str) -> DataFrame:
    return A.transcript_lines(transcripts(spark, sf))


@query
def transcript_listing(spark: SparkSession, sf: str) -> DataFrame:
    return A.transcript_listing(transcripts(spark, sf))


@query
def transcript_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Exported transcript files, read back as text."""
    path = _scratch(spark, "transcripts")
    exports.export_csv(transcripts(spark, sf), path)
    back = spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n").csv(path)
    return back.select(*[F.col(h).alias(c) for c, h in exports.CSV_HEADER.items()])


@query
def sql_views(spark: SparkSession, sf: str) -> DataFrame:
    """A report written as SQL against the registered names."""
    names = ["students", "courses", "enrollments", "grades", "attendance"]
    A.register_views(dict(zip(names, views(spark, sf, *names), strict=True)))
    return spark.sql(
        """
        SELECT t.letter_grade, t.semester, count(*) AS transcripts,
               count(DISTINCT t.student_id) AS students, sum(a.total_classes) AS classes
        FROM student_transcripts_view t
        JOIN courses c ON t.course_code = c.course_code
        LEFT JOIN attendance_stats_view a ON a.student_id = t.student_id AND a.course_id = c.course_id
        GROUP BY t.letter_grade, t.semester
        """
    )


# -- cleaning and rules -----------------------------------------------------


@query
def clean_people(spark: SparkSession, sf: str) -> DataFrame:
    feed = view(spark, sf, "people_feed")
    people = coerce(L.clean_people(feed.drop("seq")), schemas.STUDENTS)
    made = derive_email("first_name", "last_name", "campus.example", F.length("email"))
    return people.withColumn("derived_email", made)


def entry_rules() -> list[R.Rule]:
    return [
        R.required("assessment"),
        R.max_length("assessment", 50),
        R.number("score"),
        R.in_range("score", on="stored"),
        R.number("weight", "decimal(3,2)"),
        R.date_shape("entry_date"),
        R.real_date("entry_date"),
        R.one_of("status"),
        R.positive("credits"),
    ]


@query
def rule_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = R.apply_rules(view(spark, sf, "entries"), entry_rules())
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


@query
def valid_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that pass, with raw-score rule, stored types and fitted lengths."""
    checks = [*entry_rules(), R.in_range("score", on="raw")]
    valid, _ = R.apply_rules(view(spark, sf, "entries"), checks)
    dated = valid.withColumnsRenamed({"assessment": "assessment_type", "entry_date": "attendance_date"})
    typed = coerce(coerce(dated, schemas.GRADES), schemas.ATTENDANCE)
    return fit_lengths(typed, schemas.MAX_LENGTH["grades"])


@query
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Old rows with the later columns, an omitted default filled."""
    students, enrollments = views(spark, sf, "students", "enrollments")
    old = with_defaults(
        enrollments.select("enrollment_id", "student_id", "semester"),
        {"enrollment_date": F.lit(AS_OF).cast("date"), "semester": F.lit(schemas.FEED_SEMESTER)},
    )
    return evolve(students, schemas.STUDENTS).join(old, "student_id")


# -- keys -------------------------------------------------------------------


def _person_per_order(spark: SparkSession, sf: str) -> DataFrame:
    """Every order brings its student's record again, with another major."""
    orders, students = views(spark, sf, "orders_placed", "students")
    return (
        orders.join(students.drop("major"), "student_id")
        .where(F.col("email").isNotNull())
        .select(F.col("o_orderkey").alias("seq"), "email", "first_name", "last_name", F.col("priority").alias("major"))
    )


@query
def insert_new_students(spark: SparkSession, sf: str) -> DataFrame:
    target = view(spark, sf, "held_students")
    inserted, _ = K.insert_absent(target, _person_per_order(spark, sf), ["email"], ["seq"])
    return inserted


@query
def skipped_students(spark: SparkSession, sf: str) -> DataFrame:
    target = view(spark, sf, "held_students")
    _, skipped = K.insert_absent(target, _person_per_order(spark, sf), ["email"], ["seq"])
    return skipped


@query
def insert_new_courses(spark: SparkSession, sf: str) -> DataFrame:
    target, offers, again = views(spark, sf, "held_courses", "course_offers", "course_offers_again")
    seeds = L.seed_rows(spark)[1].withColumn("seq", F.lit(-1).cast("bigint"))
    batch = offers.unionByName(again).unionByName(seeds)
    inserted, _ = K.insert_absent(target, batch, ["course_code"], ["seq"])
    return inserted.drop("seq")


@query
def insert_enrollments(spark: SparkSession, sf: str) -> DataFrame:
    """Every line registers its order's student again, some without a semester."""
    target, orders, lines = views(spark, sf, "held_enrollments", "orders_placed", "lines")
    batch = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "student_id",
        "course_id",
        F.expr("case when o_orderkey % 53 = 0 then null else semester end").alias("semester"),
        F.col("ship_date").alias("enrollment_date"),
    )
    inserted, _ = K.insert_absent(target, batch, schemas.UNIQUE_KEYS["enrollments"], ["enrollment_date"])
    return inserted


@query
def assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    target = view(spark, sf, "held_students")
    new = insert_new_students(spark, sf)
    return K.assign_ids(new, "student_id", K.next_id(target, "student_id"), ["seq"]).select("student_id", "email")


@query
def load_counters(spark: SparkSession, sf: str) -> DataFrame:
    feed, target = views(spark, sf, "people_feed", "held_students")
    people = L.clean_people(feed.withColumnRenamed("seq", "feed_order"))
    inserted, _ = K.insert_absent(target, people, ["email"], ["feed_order"])
    return K.load_counters(feed, people, people, inserted)


# -- integrity --------------------------------------------------------------


@query
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    child, parent = views(spark, sf, "loose_grades", "enrollments")
    return I.orphans(child, parent, "enrollment_id", "enrollment_id")


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return I.duplicate_keys(view(spark, sf, "loose_grades"), ["enrollment_id", "assessment_type"])


@query
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Delete courses with all that hangs on them."""
    names = ["students", "courses", "enrollments", "grades", "attendance"]
    tables = dict(zip(names, views(spark, sf, *names), strict=True))
    kept, deleted = I.cascade_delete(tables, "courses", view(spark, sf, "small_courses"))
    return I.cascade_counts(kept, deleted)


@query
def delete_students(spark: SparkSession, sf: str) -> DataFrame:
    """Enrollments left after deleting debtors, and the emails nobody has."""
    names = ["students", "courses", "enrollments", "grades", "attendance"]
    tables = dict(zip(names, views(spark, sf, *names), strict=True))
    asked = view(spark, sf, "debtors").select("email").unionByName(view(spark, sf, "strangers"))
    done = C.delete_students(tables, asked)
    left = done.tables["grades"].select("enrollment_id", "assessment_type", "score")
    return left.unionByName(done.rejected.select("email", _why()), allowMissingColumns=True)


# -- commands ---------------------------------------------------------------


def _targets(spark: SparkSession, sf: str, **names: str) -> dict[str, DataFrame]:
    return {table: conform(view(spark, sf, name), schemas.TABLES[table]) for table, name in names.items()}


@query
def add_students(spark: SparkSession, sf: str) -> DataFrame:
    people = _person_per_order(spark, sf)
    orders = view(spark, sf, "orders_placed").select(F.col("o_orderkey").alias("seq"), "placed")
    dob = F.expr(
        "case when seq % 31 = 0 then '9999-99-99' when seq % 37 = 0 then '24-1-1' else cast(placed as string) end"
    )
    calls = stage(people.join(orders, "seq").withColumn("dob", dob).drop("placed"))
    done = C.add_students(_targets(spark, sf, students="held_students"), calls)
    accepted = done.added["students"].select("student_id", "email", "date_of_birth")
    return accepted.unionByName(done.rejected.select("seq", "email", _why()), allowMissingColumns=True)


@query
def register_students(spark: SparkSession, sf: str) -> DataFrame:
    """One call per order; codes beyond the catalog and NULL emails occur."""
    orders, students = views(spark, sf, "orders_placed", "students")
    calls = orders.join(students.select("student_id", "email"), "student_id").select(
        F.col("o_orderkey").alias("seq"),
        F.expr("case when o_orderkey % 59 = 0 then concat('x', email) else email end").alias("email"),
        F.expr("concat('P', cast(cast(floor(o_orderkey / 7) as bigint) as string))").alias("course_code"),
        F.expr("case when o_orderkey % 53 = 0 then 'Spring of a year long ago' else semester end").alias("semester"),
    )
    tables = _targets(spark, sf, students="students", courses="courses", enrollments="held_enrollments")
    done = C.register_students(tables, stage(calls), AS_OF)
    return done.added["enrollments"].unionByName(
        done.rejected.select("seq", "email", "course_code", _why()), allowMissingColumns=True
    )


def _calls_on_orders(spark: SparkSession, sf: str, rows: DataFrame, key: str, *columns: str) -> DataFrame:
    orders, students, courses = views(spark, sf, "orders_placed", "students", "courses")
    return (
        rows.join(orders, F.col(key) == F.col("o_orderkey"))
        .join(students.select("student_id", "email"), "student_id")
        .join(courses.select("course_id", "course_code"), "course_id")
        .select("email", "course_code", *columns)
    )


@query
def record_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Lines 5 and up set the grades that lines 1 to 4 left."""
    lines = view(spark, sf, "lines")
    held = lines.where("l_linenumber <= 4").select(
        F.col("l_orderkey").alias("enrollment_id"), "assessment_type", "score", "weight"
    )
    new = lines.where("l_linenumber > 4").withColumns(
        {
            "text": F.expr(
                "case when l_partkey % 97 = 0 then '100.004' when l_partkey % 101 = 0 then 'n/a' "
                "when l_partkey % 103 = 0 then '88d' when l_partkey % 107 = 0 then '0x1p3' "
                "when l_partkey % 109 = 0 then null else cast(score as string) end"
            ),
            "part": F.expr(
                "case when l_partkey % 83 = 0 then null when l_partkey % 89 = 0 then '12.5' "
                "else cast(weight as string) end"
            ),
        }
    )
    calls = _calls_on_orders(spark, sf, new, "l_orderkey", "assessment_type", "text", "part", *LINE_ORDER)
    order = [f"o_{c}" for c in LINE_ORDER]
    calls = calls.withColumnsRenamed(dict(zip(LINE_ORDER, order, strict=True))).withColumnsRenamed(
        {"assessment_type": "assessment", "text": "score", "part": "weight"}
    )
    tables = _targets(spark, sf, students="students", courses="courses", enrollments="enrollments")
    done = C.record_grades({**tables, "grades": conform(held, schemas.GRADES)}, stage(calls), order)
    rejected = done.rejected.select(
        F.col("assessment").alias("assessment_type"), "email", "course_code", F.col("o_score").alias("score"), _why()
    )
    return done.tables["grades"].drop("grade_id").unionByName(rejected, allowMissingColumns=True)


@query
def mark_attendance(spark: SparkSession, sf: str) -> DataFrame:
    marks = view(spark, sf, "event_rows")
    calls = _calls_on_orders(spark, sf, marks, "enrollment_id", "seq", "attendance_date", "status")
    tables = _targets(
        spark, sf, students="students", courses="courses", enrollments="enrollments", attendance="attendance"
    )
    done = C.mark_attendance(tables, stage(calls))
    return done.added["attendance"].unionByName(
        done.rejected.select("seq", "status", _why()), allowMissingColumns=True
    )


def _grade_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines 1 to 3 grade their order's course, the others a course of their part."""
    lines, orders = views(spark, sf, "lines", "orders_placed")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("student_id").alias("student_ref_id"),
        F.expr(
            "concat('P', cast(case when l_linenumber <= 3 then course_id else l_partkey + 50 end as string))"
        ).alias("course_code_ref"),
        F.col("assessment_type").alias("assessment"),
        F.col("score").cast("string").alias("score"),
        F.col("weight").cast("string").alias("weight"),
    )


def _feed_targets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    tables = _targets(spark, sf, students="students", courses="courses", enrollments="enrollments", grades="grades")
    return {**tables, "students": tables["students"].where(F.col("email").isNotNull())}


def _feed_result(done: C.Outcome) -> DataFrame:
    pairs = done.tables["enrollments"].select("enrollment_id", "student_id", "course_id", "semester")
    loaded = done.added["grades"].drop("grade_id").join(pairs, "enrollment_id")
    skipped = done.rejected.select(
        F.col("student_ref_id").alias("student_id"),
        "course_code_ref",
        F.col("score").cast(schemas.SCORE).alias("score"),
        _why(),
    )
    return loaded.unionByName(skipped, allowMissingColumns=True)


@query
def grade_feed_load(spark: SparkSession, sf: str) -> DataFrame:
    return _feed_result(C.load_grades(_feed_targets(spark, sf), stage(_grade_feed(spark, sf)), AS_OF))


# -- feeds and files --------------------------------------------------------


@query
def people_csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """The people feed written as CSV, read back and loaded."""
    path = _scratch(spark, "people")
    feed, target = views(spark, sf, "people_feed", "held_students")
    # another column order, a column nobody asked for, line breaks inside quotes
    broken = F.expr("case when seq % 19 = 0 then concat(major, '\n', major) else major end")
    told = feed.withColumn("major", broken).select("major", "dob", F.lit("x").alias("note"), "email", "last_name", "first_name")
    feeds.write_csv_feed(told, path)
    tables = {"students": conform(target, schemas.STUDENTS)}
    done, _ = L.load_people(tables, stage(feeds.read_people(spark, path, multi_line=True)), strict=False)
    loaded = done.added["students"].select("first_name", "last_name", "email", "date_of_birth", "major")
    return loaded.unionByName(done.rejected.select("email", _why()), allowMissingColumns=True)


@query
def catalog_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two offers of every course; credits are words, fractions, nothing or none at times."""
    offers, target = views(spark, sf, "course_offers", "held_courses")
    again = offers.withColumn("seq", F.expr("seq + 100000000"))
    text = F.expr(
        "case when seq % 7 = 0 then 'three' when seq % 11 = 0 then '3.7' when seq % 13 = 0 then '0' "
        "when seq % 17 = 0 then null else cast(credits as string) end"
    )
    code = F.expr("case when seq % 23 = 0 then null else course_code end")
    feed = offers.unionByName(again).select(
        "course_name", code.alias("course_code"), text.alias("credits"), F.col("seq").alias("feed_order")
    )
    done, _ = L.load_catalog({"courses": conform(target, schemas.COURSES)}, stage(feed), strict=False)
    loaded = done.added["courses"].select("course_code", "course_name", "credits")
    return loaded.unionByName(done.rejected.select(F.col("feed_order").alias("seq"), _why()), allowMissingColumns=True)


@query
def grade_json_load(spark: SparkSession, sf: str) -> DataFrame:
    """The grade feed written as JSON, read back and loaded."""
    path = _scratch(spark, "grades")
    feeds.write_json_feed(_grade_feed(spark, sf), path)
    feed = stage(feeds.read_grades(spark, path, json_lines=True))
    return _feed_result(C.load_grades(_feed_targets(spark, sf), feed, AS_OF))


@query
def grade_array_load(spark: SparkSession, sf: str) -> DataFrame:
    """The grade feed as one file that is a JSON array, with braces and quotes in its strings."""
    path = _scratch(spark, "grades")
    odd = F.expr("case when cast(score as double) >= 70 then concat(assessment, ' }\"{') else assessment end")
    feeds.write_json_array(_grade_feed(spark, sf).withColumn("assessment", odd), path)
    return _feed_result(C.load_grades(_feed_targets(spark, sf), stage(feeds.read_grades(spark, path)), AS_OF))


@query
def seed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The starting rows inserted where their keys are absent, and once only."""
    tables = _targets(spark, sf, students="students", courses="courses")
    seeded = L.seed(L.seed(tables, spark), spark)
    people = seeded["students"].select("student_id", "first_name", "last_name", "email", "major")
    return people.unionByName(seeded["courses"].select("course_id", "course_name", "course_code", "credits"), allowMissingColumns=True)


@query
def packed_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV file per student, packed into few; those of the debtors read back by the index."""
    path = _scratch(spark, "packed")
    exports.export_packed(transcripts(spark, sf), path)
    return exports.read_packed(spark, path, view(spark, sf, "debtors"))


@query
def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Five tables published, attendance appended, the whole read back and reported on."""
    store = TableStore(spark, _scratch(spark, "store"))
    names = ["students", "courses", "enrollments", "attendance"]
    tables = dict(zip(names, views(spark, sf, *names), strict=True))
    grades = K.assign_ids(view(spark, sf, "grades"), "grade_id", 1)
    store.publish(replace={**tables, "grades": grades})
    store.publish(append={"attendance": tables["attendance"]})
    now = store.read()
    stats = A.attendance_stats(now["attendance"], now["enrollments"])
    return A.at_risk(stats, now["students"], now["courses"])


@query
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """People file, catalog frame and grade array loaded into an empty store: what it holds, and the counters."""
    root = _scratch(spark, "run")
    feeds.write_csv_feed(view(spark, sf, "people_feed").drop("seq"), f"{root}/people")
    feeds.write_json_array(_grade_feed(spark, sf), f"{root}/grades")
    catalog = view(spark, sf, "course_offers").withColumn("credits", F.col("credits").cast("string"))
    store = TableStore(spark, f"{root}/store")
    sources = L.Sources(people=f"{root}/people", catalog=catalog.withColumnRenamed("seq", "feed_order"), grades=f"{root}/grades")
    report = L.run_loads(spark, sources, store, AS_OF, strict=False)
    now = store.read()
    counts = Q.row_count_checks(now).select("table", F.col("rows"), "passed")
    people = now["students"].select("email", "first_name", "last_name", "major", "date_of_birth")
    courses = now["courses"].select("course_code", "course_name", "credits")
    names = now["enrollments"].join(now["students"].select("student_id", "email"), "student_id")
    names = names.join(now["courses"].select("course_id", "course_code"), "course_id").select("enrollment_id", "email", "course_code")
    graded = now["grades"].join(names, "enrollment_id").select("email", "course_code", "assessment_type", "score", "weight")
    told = [(feed, metric, rows) for feed, c in report.counters.items() for metric, rows in c.items()]
    counters = spark.createDataFrame(told, "feed string, metric string, rows bigint")
    out = counts
    for part in (people, courses, graded, counters):
        out = out.unionByName(part, allowMissingColumns=True)
    return out


@query
def command_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Attendance commands as files, applied by a stream to the stored tables."""
    root = _scratch(spark, "stream")
    marks = view(spark, sf, "event_rows")
    calls = _calls_on_orders(spark, sf, marks, "enrollment_id", "seq", "status")
    calls.write.json(f"{root}/in")
    store = TableStore(spark, f"{root}/store")
    names = ["students", "courses", "enrollments"]
    store.publish(replace=dict(zip(names, views(spark, sf, *names), strict=True)))
    stream = start_command_stream(spark, f"{root}/in", store, "mark_attendance", f"{root}/checkpoint", AS_OF)
    stream.awaitTermination()
    return store.read()["attendance"].select("enrollment_id", "attendance_date", "status")


@query
def grade_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Grade commands in many small files, a few to a batch; the commands of a grade are in one file."""
    root = _scratch(spark, "stream")
    lines = view(spark, sf, "lines").withColumn("seq", F.expr("l_orderkey * 100000000 + l_partkey * 10 + l_linenumber"))
    calls = _calls_on_orders(spark, sf, lines, "l_orderkey", "seq", "assessment_type", "score", "weight")
    calls = calls.select(
        "seq",
        "email",
        "course_code",
        F.col("assessment_type").alias("assessment"),
        F.col("score").cast("string").alias("score"),
        F.col("weight").cast("string").alias("weight"),
    )
    calls.repartition(6, "email", "course_code", "assessment").write.json(f"{root}/in")
    store = TableStore(spark, f"{root}/store")
    names = ["students", "courses", "enrollments"]
    store.publish(replace=dict(zip(names, views(spark, sf, *names), strict=True)))
    stream = start_command_stream(spark, f"{root}/in", store, "record_grades", f"{root}/checkpoint", AS_OF, max_files=3)
    stream.awaitTermination()
    return store.read()["grades"].select("enrollment_id", "assessment_type", "score", "weight")


@query
def ordered_grade_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Grade commands and registrations in four deliveries, without regard to ``seq`` or to which comes first."""
    root = _scratch(spark, "stream")
    lines, orders = views(spark, sf, "lines", "orders_placed")
    grades = lines.withColumns(
        {
            "verb": F.lit(ordered.RECORD),
            "seq": F.expr("l_orderkey * 100000000 + l_partkey * 10 + l_linenumber"),
            "text": F.expr("case when l_partkey % 97 = 0 then 'x' else cast(score as string) end"),
            "part": F.expr("l_suppkey % 4"),
        }
    )
    calls = _calls_on_orders(spark, sf, grades, "l_orderkey", "verb", "seq", "assessment_type", "text", "weight", "part")
    calls = calls.withColumnsRenamed({"assessment_type": "assessment", "text": "score"})
    # orders that are not held register in the second and the fourth delivery, one in seven never
    entries = orders.where("o_orderkey % 7 <> 0").select(
        F.col("o_orderkey").alias("key"), F.lit(ordered.REGISTER).alias("verb"), F.col("o_orderkey").alias("number"),
        F.col("semester").alias("term"), F.expr("1 + 2 * (o_orderkey % 2)").alias("part"),
    )
    open_ones = view(spark, sf, "enrollments").join(view(spark, sf, "held_enrollments"), "enrollment_id", "left_anti")
    entries = entries.join(open_ones.select(F.col("enrollment_id").alias("key")), "key")
    entries = _calls_on_orders(spark, sf, entries, "key", "verb", "number", "term", "part")
    entries = entries.withColumnsRenamed({"number": "seq", "term": "semester"})
    events = stage(calls.withColumn("weight", F.col("weight").cast("string")).unionByName(entries, allowMissingColumns=True))
    store = TableStore(spark, f"{root}/store")
    students, courses, held = views(spark, sf, "students", "courses", "held_enrollments")
    store.publish(replace={"students": students, "courses": courses, "enrollments": held})
    for part in range(4):
        events.where(F.col("part") == part).drop("part").write.mode("append").json(f"{root}/in")
        ordered.start_ordered_stream(spark, f"{root}/in", store, f"{root}/checkpoint", AS_OF).awaitTermination()
    now = store.read()
    pairs = now["enrollments"].join(now["students"], "student_id").join(now["courses"], "course_id")
    graded = now["grades"].join(pairs.select("enrollment_id", "email", "course_code"), "enrollment_id").select(
        "email", "course_code", F.col("assessment_type").alias("assessment"), "score", "weight", F.lit("graded").alias("status")
    )
    waiting = ordered.still_waiting(store).select(
        "email", "course_code", "assessment", F.col("score").cast(schemas.SCORE).alias("score"),
        F.col("weight").cast(schemas.WEIGHT).alias("weight"), F.lit("waiting").alias("status"),
    )
    return graded.unionByName(waiting)


@query
def late_references(spark: SparkSession, sf: str) -> DataFrame:
    """Grades and attendance marks come first, the courses and students they name later."""
    store = TableStore(spark, _scratch(spark, "late"))
    marks = _calls_on_orders(spark, sf, view(spark, sf, "event_rows"), "enrollment_id", "seq", "status")
    late.submit(store, late.FEED, _grade_feed(spark, sf), "grades", AS_OF)
    late.submit(store, "mark_attendance", marks, "marks", AS_OF)
    students, courses = views(spark, sf, "students", "courses")
    store.publish(append={"courses": courses.where("course_id % 11 <> 0")})
    late.settle(store, AS_OF)
    store.publish(append={"students": students.where("email IS NOT NULL")})
    late.settle(store, AS_OF)
    now = store.read()
    pairs = now["enrollments"].select("enrollment_id", "student_id", "course_id", "semester")
    loaded = now["grades"].join(pairs, "enrollment_id").select("student_id", "course_id", "semester", "assessment_type", "score", "weight")
    marked = now["attendance"].join(pairs, "enrollment_id").groupBy("student_id", "course_id", "status").agg(F.count("*").alias("rows"))
    waiting = store.waiting().groupBy(F.col("verb").alias("semester"), F.col("waits_for").alias("status")).agg(F.count("*").alias("rows"))
    return loaded.unionByName(marked, allowMissingColumns=True).unionByName(waiting, allowMissingColumns=True)


@query
def incremental_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Three reports from signed sums, after a base, additions, changed grades and deletions."""
    store = TableStore(spark, _scratch(spark, "sums"))
    names = ["students", "courses", "enrollments", "attendance", "held_enrollments", "lines"]
    students, courses, enrollments, attendance, held, lines = views(spark, sf, *names)
    early = lines.where("l_linenumber <= 4").withColumnRenamed("l_orderkey", "enrollment_id")
    early = K.assign_ids(early.select("enrollment_id", "assessment_type", "score", "weight"), "grade_id", 1)
    is_held = held.select("enrollment_id")
    of_held = lambda rows, how: rows.join(is_held, "enrollment_id", how)
    N.publish(
        store,
        append={"students": students, "courses": courses, "enrollments": held, "grades": of_held(early, "left_semi"),
                "attendance": of_held(attendance, "left_semi")},
    )
    rest = {"enrollments": of_held(enrollments, "left_anti"), "grades": of_held(early, "left_anti")}
    N.publish(store, append={**rest, "attendance": of_held(attendance, "left_anti")})
    late_lines = lines.where("l_linenumber > 4").withColumn("enrollment_id", F.col("l_orderkey"))
    value = F.struct(*LINE_ORDER)
    last = late_lines.groupBy("enrollment_id", "assessment_type").agg(F.max(value).alias("last"))
    changes = stage(last.select("enrollment_id", "assessment_type", F.col("last.score").alias("new_score"), F.col("last.weight").alias("new_weight")))
    N.publish(store, append={"grades": C.new_grades(store.read()["grades"], changes, store.next_ids())}, changes=changes)
    gone = students.where("student_id % 13 = 0")
    now = store.read()
    kept, _ = I.cascade_delete(now, "students", gone.select("student_id"))
    N.publish(store, replace={n: kept[n] for n in ("students", "enrollments", "grades", "attendance")}, deleted_students=gone)
    store.compact()
    N.publish(store, append={"attendance": kept["attendance"].limit(0)})
    now, facts = store.read(), store.facts()
    performance = N.course_performance(facts, now["courses"]).withColumn("report", F.lit("performance"))
    stats = N.attendance_stats(facts).withColumn("report", F.lit("attendance"))
    papers = N.transcripts(facts, now["students"], now["courses"]).drop("first_name", "last_name", "email", "credits", "course_name")
    out = performance.drop("course_name").unionByName(stats, allowMissingColumns=True)
    return out.unionByName(papers.withColumn("report", F.lit("transcript")), allowMissingColumns=True)


# -- quality ----------------------------------------------------------------


@query
def row_count_checks(spark: SparkSession, sf: str) -> DataFrame:
    names = ["students", "courses", "enrollments", "grades", "attendance"]
    return Q.row_count_checks(dict(zip(names, views(spark, sf, *names), strict=True)))


@query
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    names = ["students", "courses", "enrollments", "attendance", "entries"]
    tables = dict(zip(names, views(spark, sf, *names), strict=True))
    tables["grades"] = view(spark, sf, "loose_grades")
    return Q.dq_summary(
        tables,
        rules={"entries": entry_rules(), "students": R.table_rules("students", ["first_name", "email"])},
        keys=[
            ("students", ["student_id"]),
            ("students", ["email"]),
            ("enrollments", ["student_id", "course_id", "semester"]),
            ("grades", ["enrollment_id", "assessment_type"]),
        ],
        bounds=Q.BOUNDS,
    )


# -- patterns ---------------------------------------------------------------


@query
def calendar_spine(spark: SparkSession, sf: str) -> DataFrame:
    enrolled = view(spark, sf, "enrollments").select("enrollment_id", "enrollment_date")
    return P.calendar_spine(enrolled, F.date_sub("enrollment_date", 45)).select("enrollment_id", "class_date")


@query
def sample_courses(spark: SparkSession, sf: str) -> DataFrame:
    students, courses = views(spark, sf, "students", "courses")
    k = (P.draw(SEED, F.col("student_id")) % 4 + 3).alias("k")
    return P.sample_per_group(students, courses, "student_id", "course_id", k, SEED)


@query
def backfill_children(spark: SparkSession, sf: str) -> DataFrame:
    enrollments, grades = views(spark, sf, "enrollments", "grades")
    template = [
        {"assessment_type": F.lit(name), "weight": F.lit(weight).cast(schemas.WEIGHT)}
        for name, weight in (("Midterm", "0.30"), ("Final", "0.50"), ("Project", "0.20"))
    ]
    return P.backfill_children(enrollments, grades, "enrollment_id", template)


@query
def backfill_attendance(spark: SparkSession, sf: str) -> DataFrame:
    """Class days for enrollments without any attendance row."""
    enrollments, attendance = views(spark, sf, "enrollments", "attendance")
    template = [{"status": F.lit("Present")}]
    bare = P.backfill_children(enrollments, attendance, "enrollment_id", template)
    start = F.date_sub(F.lit(AS_OF).cast("date"), 45)
    return P.calendar_spine(bare, start, name="attendance_date")
