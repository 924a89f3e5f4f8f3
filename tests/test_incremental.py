"""Reports from signed sums equal those from the tables, and read nothing else."""

from __future__ import annotations

from rollbook.operators import integrity as I
from rollbook.plans import commands as C
from rollbook.plans import incremental as N
from rollbook.plans import reports as A
from rollbook.sources.store import TableStore

from .conftest import rows


def same(store):
    now, facts = store.read(), store.facts()
    assert rows(N.course_performance(facts, now["courses"])) == rows(A.course_performance(now["courses"], now["enrollments"], now["grades"]))
    assert rows(N.attendance_stats(facts)) == rows(A.attendance_stats(now["attendance"], now["enrollments"]))
    want = A.transcripts(now["students"], now["courses"], now["enrollments"], now["grades"])
    assert rows(N.transcripts(facts, now["students"], now["courses"])) == rows(want)


def test_sums_follow_the_publishes(spark, tmp_path, school, make):
    store = TableStore(spark, str(tmp_path / "store"))
    N.publish(store, append={k: school[k] for k in ("students", "courses", "enrollments", "grades")})
    same(store)
    N.publish(store, append={"attendance": school["attendance"]})
    # the duplicate key 12/Midterm changes in both its rows; a score becomes NULL, one is new
    changes = spark.createDataFrame(
        [(12, "Midterm", "10", "0.1"), (10, "Final", None, None), (13, "Final", "99", "0.2")],
        "enrollment_id long, assessment_type string, s string, w string",
    ).selectExpr("enrollment_id", "assessment_type", "cast(s as decimal(5,2)) new_score", "cast(w as decimal(3,2)) new_weight")
    new = C.new_grades(store.read()["grades"], changes, store.next_ids())
    N.publish(store, append={"grades": new}, changes=changes)
    same(store)
    before = store.version()
    gone = school["students"].where("student_id = 1")
    kept, _ = I.cascade_delete(store.read(), "students", gone.select("student_id"))
    N.publish(store, replace={n: kept[n] for n in ("students", "enrollments", "grades", "attendance")}, deleted_students=gone)
    same(store)
    assert store.facts(before).count() == 2  # what that publish altered
    store.compact()
    same(store)
    files = N.course_performance(store.facts(), store.read()["courses"]).inputFiles()
    assert files and all("/facts/" in f or "/courses" in f for f in files)


def test_folded_rows_meet_the_enrollments_once(spark, school):
    before = {k: school[k] for k in ("enrollments", "grades")}
    facts = N.signed_facts(before, {"grades": school["grades"], "attendance": school["attendance"]})
    assert facts._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_only_rows_older_than_a_change_are_met_with_it(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    grade = lambda i, s: spark.createDataFrame(
        [(i, 1, "Final", s)], "grade_id long, enrollment_id long, assessment_type string, score string"
    ).selectExpr("grade_id", "enrollment_id", "assessment_type", "cast(score as decimal(5,2)) score", "cast(0.5 as decimal(3,2)) weight")
    change = lambda s: grade(0, s).selectExpr("enrollment_id", "assessment_type", "score new_score", "weight new_weight")
    scores = lambda: {r["grade_id"]: r["score"] and int(r["score"]) for r in store.read()["grades"].collect()}
    plan = lambda: store.read()["grades"]._jdf.queryExecution().optimizedPlan().toString()
    store.publish(append={"grades": grade(1, "10")})
    store.publish(append={"grades": grade(2, "20")}, changes=change("90"))
    assert scores() == {1: 90, 2: 20}
    assert plan().startswith("Union")  # the new row is beside the join, not in it
    store.publish(append={"grades": grade(3, "30")})
    store.publish(changes=change(None))
    store.publish(append={"grades": grade(4, "40")})
    assert scores() == {1: None, 2: None, 3: None, 4: 40}
