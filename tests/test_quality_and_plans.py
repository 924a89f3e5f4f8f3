from __future__ import annotations

import pytest

from checks import queries as Qs
from checks.compare import connect, difference
from checks.oracles import statements
from rollbook.operators import rules as R
from rollbook.plans import quality as Q
from rollbook.plans import reports as A
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_out_of_range_grade_is_counted(make, school):
    grades = school["grades"].selectExpr("grade_id", "cast(score * 3 as decimal(7,2)) AS score")
    got = Q.rule_counts(grades, "grades", [R.in_range("score", dtype="decimal(7,2)")])
    assert rows(got) == [("score_out_of_range", "grades", 4, 4)]


def test_volume(school):
    got = Q.row_count_checks(school)
    assert rows(got, "table", "rows", "passed") == [
        ("attendance", 8, True),
        ("courses", 3, False),
        ("enrollments", 4, True),
        ("grades", 4, True),
        ("students", 2, False),
    ]


def test_summary(make, school):
    tables = {**school, "grades": make("grades", "grade_id enrollment_id assessment_type score", [(1, 99, "a", 1.0), (1, None, "a", 1.0)])}
    got = Q.dq_summary(tables, {"grades": R.table_rules("grades", ["score"])}, bounds={"courses": (1, 5)})
    failed = {(r["rule"], r["table"]): r["failed"] for r in got.collect() if not r["passed"]}
    assert failed == {("unique_grade_id", "grades"): 1, ("orphan_enrollment_id", "grades"): 1}


def test_scans_read_only_what_is_used(spark):
    four = Qs.views(spark, SF, "courses", "enrollments", "grades")
    text = A.course_performance(*four)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "l_discount" not in text and "o_custkey" not in text and "p_size" not in text


def test_email_filter_reaches_the_scan(spark, tmp_path, school):
    for name, df in school.items():
        df.write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in school}
    t = A.transcripts(*[tables[n] for n in ("students", "courses", "enrollments", "grades")])
    assert "EqualTo(email,ann@x)" in plan(t.where("email = 'ann@x'"))


@pytest.mark.parametrize("name", sorted(statements()))
def test_against_sql(spark, name):
    df = Qs.registry()[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert difference(df, connect(SF), statements()[name]) is None


def test_every_query_has_a_statement():
    assert set(statements()) == set(Qs.registry())
