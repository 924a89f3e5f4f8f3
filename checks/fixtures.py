"""The academic tables over the driver's tables.

Every view is a projection of one whole table.  The expressions read the same
in Spark SQL and in DuckDB, so both sides of a check start from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCORE = "least(100.0, 40 + 0.6 * l_quantity + (l_orderkey % 40) - l_tax)"
_EMAIL = "concat(lower(replace(c_name, '#', '.')), '@example.org')"
_COURSE = "cast(floor(o_orderkey / 10) as bigint)"
_SEMESTER = (
    "concat(case when month(o_orderdate) <= 6 then 'Spring ' else 'Fall ' end, "
    "cast(year(o_orderdate) as string))"
)

_STUDENT = {
    "student_id": "c_custkey",
    "first_name": "split_part(c_name, '#', 1)",
    "last_name": "split_part(c_name, '#', 2)",
    "email": f"case when c_custkey % 10 = 3 then null else {_EMAIL} end",
    "major": "c_mktsegment",
}
_COURSE_ROW = {
    "course_id": "p_partkey",
    "course_name": "p_name",
    "course_code": "concat('P', cast(p_partkey as string))",
    "credits": "p_size % 4 + 1",
}
_ENROLLMENT = {
    "enrollment_id": "o_orderkey",
    "student_id": "o_custkey",
    "course_id": _COURSE,
    "enrollment_date": "cast(o_orderdate as date)",
    "semester": _SEMESTER,
}
_GRADE = {
    "enrollment_id": "l_orderkey",
    "assessment_type": "l_returnflag",
    "score": f"cast({_SCORE} as decimal(5,2))",
    "weight": "cast(l_discount as decimal(3,2))",
}

# name: (source table, {column: expression}, condition)
VIEWS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "students": ("customer", _STUDENT, None),
    "courses": ("part", _COURSE_ROW, None),
    "enrollments": ("orders", _ENROLLMENT, None),
    "grades": ("lineitem", _GRADE, None),
    "attendance": (
        "events",
        {
            "attendance_id": "event_id",
            "enrollment_id": "user_id * 10 + event_id % 10",
            "attendance_date": "cast(ts as date)",
            "status": "case when event_type = 'signup' then 'Late' "
            "when event_type = 'error' then case when event_id % 2 = 0 then 'Absent' else 'Excused' end "
            "else 'Present' end",
        },
        None,
    ),
    # What a target table holds before a load or a command run.
    "held_students": ("customer", _STUDENT, "c_acctbal >= 5000"),
    "held_courses": ("part", _COURSE_ROW, "p_size >= 25"),
    "held_enrollments": ("orders", _ENROLLMENT, "o_orderstatus = 'F'"),
    "debtors": ("customer", _STUDENT, "c_acctbal < 0"),
    "small_courses": ("part", _COURSE_ROW, "p_size < 5"),
    # Emails nobody has.
    "strangers": ("supplier", {"email": "concat(lower(replace(s_name, '#', '.')), '@example.org')"}, None),
    # Feeds and commands, with dirt.
    "people_feed": (
        "customer",
        {
            "seq": "c_custkey",
            "first_name": "split_part(c_name, '#', 1)",
            "last_name": "split_part(c_name, '#', 2)",
            "email": "case when c_custkey % 10 = 3 then '' when c_custkey % 25 = 4 then 'N/A' "
            f"when c_custkey % 50 = 17 then null else {_EMAIL} end",
            "dob": "case when c_custkey % 41 = 0 then '9999-99-99' else concat('19', "
            "cast(60 + c_nationkey as string), '-0', cast(c_custkey % 9 + 1 as string), '-1', "
            "cast(c_custkey % 10 as string)) end",
            "major": "c_mktsegment",
        },
        None,
    ),
    "entries": (
        "lineitem",
        {
            "enrollment_id": "l_orderkey",
            # 8 to 56 letters, blanks behind; one length of one letter is missing
            "assessment": "nullif(concat(repeat(l_returnflag, l_linenumber * 8), repeat(' ', l_linenumber * 8)), "
            "concat(repeat('A', 8), repeat(' ', 8)))",
            # three digits behind the point, up to 101; 77 is no number
            "score": "replace(concat(cast(l_partkey % 102 as string), '.00', cast(l_linenumber as string)), '77.', 'x')",
            "weight": "concat(cast(l_suppkey % 11 as string), '.5')",
            # February has days in the forties, some of March a short month
            "entry_date": "replace(replace(cast(cast(l_shipdate as date) as string), '-02-1', '-02-4'), '-03-2', '-3-2')",
            "status": "case when l_linenumber = 7 then 'Here' else 'Late' end",
            "credits": "cast(l_quantity as int) - 2",
        },
        None,
    ),
    "loose_grades": (
        "lineitem",
        {
            **_GRADE,
            "enrollment_id": "case when l_partkey % 89 = 0 then l_orderkey + 10000000 "
            "when l_partkey % 83 = 0 then null else l_orderkey end",
        },
        None,
    ),
    "course_offers": (
        "part",
        {
            "seq": "2 * p_partkey + 1",
            "course_name": "p_name",
            "course_code": "concat('P', cast(p_partkey as string))",
            "credits": "p_size % 4 + 1",
        },
        None,
    ),
    "course_offers_again": (
        "part",
        {
            "seq": "2 * p_partkey",
            "course_name": "p_type",
            "course_code": "concat('P', cast(p_partkey as string))",
            "credits": "p_size % 3 + 1",
        },
        None,
    ),
    # Keys of a line's order; joined below.
    "lines": (
        "lineitem",
        {
            "l_orderkey": "l_orderkey",
            "l_partkey": "l_partkey",
            "l_suppkey": "l_suppkey",
            "l_linenumber": "l_linenumber",
            "l_quantity": "l_quantity",
            "l_extendedprice": "l_extendedprice",
            "l_linestatus": "l_linestatus",
            "ship_date": "cast(l_shipdate as date)",
            **{k: v for k, v in _GRADE.items() if k != "enrollment_id"},
        },
        None,
    ),
    "orders_placed": (
        "orders",
        {
            "o_orderkey": "o_orderkey",
            "student_id": "o_custkey",
            "course_id": _COURSE,
            "semester": _SEMESTER,
            "placed": "cast(o_orderdate as date)",
            "priority": "o_orderpriority",
        },
        None,
    ),
    "event_rows": (
        "events",
        {
            "seq": "event_id",
            "enrollment_id": "user_id * 10 + event_id % 10",
            "attendance_date": "case when event_id % 43 = 0 then null else cast(ts as date) end",
            "status": "case when event_type = 'signup' then 'Late' when event_type = 'error' then 'Absent' "
            "when event_type = 'click' and event_id % 4 = 0 then 'Here' else 'Present' end",
        },
        None,
    ),
}

# Total order over the lines of an order: every column that tells copies apart.
LINE_ORDER = [
    "ship_date",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_linestatus",
    "score",
    "weight",
]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, condition = VIEWS[name]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if condition:
        df = df.where(condition)
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def with_views(body: str, *names: str) -> str:
    """DuckDB statement with the named views in front.

    ``body`` is a SELECT or, to add common tables of its own, starts with a comma.
    """
    parts = []
    for name in names:
        source, columns, condition = VIEWS[name]
        cols = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        where = f" WHERE {condition}" if condition else ""
        parts.append(f"{name} AS (SELECT {cols} FROM {source}{where})")
    body = body.strip()
    glue = "" if body.startswith(",") else "\n"
    recursive = "RECURSIVE " if "/*recursive*/" in body else ""
    return f"WITH {recursive}" + ",\n".join(parts) + glue + body
