from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.errors import AnalysisException

from rollbook import schemas
from rollbook.plans import commands as C
from rollbook.plans import loads as L
from rollbook.plans import reports as A
from rollbook.sources import exports, feeds
from rollbook.sources.store import TableStore
from rollbook.streaming.commands import apply_batch, start_command_stream
from tests.conftest import rows

PEOPLE = """first_name,last_name,email,dob,major
Ann,Low,ann@x,2000-01-31,Art
Nul,Email,,2000-01-31,Art
Ann,Again,ann@x,2001-01-31,Art
Na,Email,N/A,2000-01-31,Art
"Cid, Jr","Quo""te",cid@x,2000-02-29,External Transfer
"""


def write_people(folder):
    path = folder / "people.csv"
    path.write_text(PEOPLE)
    return str(path)


def write_grades(folder, items):
    path = folder / "grades.json"
    path.write_text(json.dumps(items, indent=4))
    return str(path)


def catalog(spark, *table):
    rows_ = [(*r, i) for i, r in enumerate(table)]
    return spark.createDataFrame(rows_, "course_name string, course_code string, credits string, feed_order int")


CATALOG = [("Robots", "R1", "3"), ("Ethics", "E1", "2")]


def test_people_feed(spark, tmp_path):
    feed = feeds.read_people(spark, write_people(tmp_path))
    assert feed.count() == 5
    assert rows(L.clean_people(feed), "first_name", "last_name", "email") == [
        ("Ann", "Again", "ann@x"),
        ("Ann", "Low", "ann@x"),
        ("Cid, Jr", 'Quo"te', "cid@x"),
    ]


def test_first_line_of_the_file_wins(spark, tmp_path, school):
    feed = feeds.read_people(spark, write_people(tmp_path))
    done, counters = L.load_people({"students": school["students"].limit(0)}, feed)
    assert rows(done.added["students"], "student_id", "last_name", "date_of_birth") == [
        (1, "Low", dt.date(2000, 1, 31)),
        (2, 'Quo"te', dt.date(2000, 2, 29)),
    ]
    assert {r["metric"]: r["rows"] for r in counters.collect()} == {
        "extracted": 5,
        "kept": 3,
        "processed": 3,
        "inserted": 2,
        "skipped": 1,
    }


def test_missing_files(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    assert feeds.read_people(spark, nowhere).count() == 0
    assert feeds.read_grades(spark, nowhere).count() == 0
    with pytest.raises(AnalysisException):
        feeds.read_people(spark, nowhere, optional=False)


def test_grade_feed_array_and_lines(spark, tmp_path):
    items = [
        {"student_ref_id": 1, "course_code_ref": "M1", "assessment": "Final", "score": 88.5, "weight": 0.4},
        {"student_ref_id": 2, "course_code_ref": "M1", "assessment": "Final", "score": 60},
    ]
    feed = feeds.read_grades(spark, write_grades(tmp_path, items))
    assert rows(feed, "student_ref_id", "score", "weight") == [(1, "88.5", "0.4"), (2, "60", None)]
    names = schemas.GRADE_FEED.names
    feeds.write_json_feed(feed.select(names), str(tmp_path / "lines"))
    again = feeds.read_grades(spark, str(tmp_path / "lines"), json_lines=True)
    assert rows(again, *names, feeds.ABSENT) == rows(feed, *names, feeds.ABSENT)
    (tmp_path / "broken.json").write_text("[{")
    with pytest.raises(Exception, match="MALFORMED|malformed|parse"):
        feeds.read_grades(spark, str(tmp_path / "broken.json")).collect()


def test_key_missing_is_an_error_but_null_is_not(spark, tmp_path, school):
    good = {"student_ref_id": 1, "course_code_ref": "M1", "assessment": "F", "score": None, "weight": 0.4}

    def load(item, strict):
        return C.load_grades(school, feeds.read_grades(spark, write_grades(tmp_path, [item])), strict=strict)

    assert rows(load(good, True).added["grades"], "score") == [(None,)]
    short = {k: v for k, v in good.items() if k != "score"}
    with pytest.raises(ValueError, match="score_absent"):
        load(short, True)
    assert rows(load(short, False).rejected, "reasons") == [(["score_absent"],)]
    # the student is looked up before the score is read
    assert rows(load({**short, "student_ref_id": 9}, True).rejected, "reasons") == [(["student_not_found"],)]
    with pytest.raises(ValueError, match="student_ref_id_absent"):
        load({k: v for k, v in good.items() if k != "student_ref_id"}, True)


def test_catalog_refuses_words_and_fractions(spark, school):
    feed = catalog(spark, *CATALOG, ("Word", "W1", "three"), ("Part", "W2", "3.7"), ("None", "W3", "0"), ("Blank", "B1", None), ("Whole", "W4", "4.0"))
    with pytest.raises(ValueError, match="credits"):
        L.load_catalog(school, feed)
    done, counters = L.load_catalog(school, feed, strict=False)
    assert rows(done.added["courses"], "course_code", "credits") == [("B1", None), ("E1", 2), ("R1", 3), ("W4", 4)]
    assert rows(done.rejected, "course_code", "reasons") == [
        ("W1", ["credits_bad_number"]),
        ("W2", ["credits_bad_number"]),
        ("W3", ["credits_not_positive"]),
    ]


def test_people_by_header_name(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text(
        'major,note,email,dob,last_name,first_name\n"Fine\nArt",x,ann@x,2000-01-31,Low,Ann\n'
        "Art,x,bob@x,2000-01-31,High,Bob,left,over\nArt,x,cid@x\n"
    )
    feed = feeds.read_people(spark, str(path), multi_line=True)
    assert rows(feed, "email", "first_name", "major", feeds.SURPLUS) == [
        ("ann@x", "Ann", "Fine\nArt", None),
        ("bob@x", "Bob", "Art", "left"),
        ("cid@x", None, "Art", None),
    ]
    done, _ = L.load_people({"students": spark.createDataFrame([], schemas.STUDENTS)}, feed, strict=False)
    assert rows(done.added["students"], "email") == [("ann@x",)]
    assert rows(done.rejected, "email", "reasons") == [
        ("bob@x", ["surplus_fields"]),
        ("cid@x", ["first_name_missing", "last_name_missing"]),
    ]
    (tmp_path / "short.csv").write_text("email,dob\nann@x,2000-01-31\n")
    with pytest.raises(ValueError, match="lacks first_name"):
        feeds.read_people(spark, str(tmp_path / "short.csv"))


def test_store_publishes_whole_states(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.version() == 0 and store.read()["students"].count() == 0
    assert store.publish(replace=school, batch="first") == 1
    assert store.publish(append={"attendance": school["attendance"].limit(2)}) == 2
    assert {n: df.count() for n, df in store.read().items()} == {
        "students": 2,
        "courses": 3,
        "enrollments": 4,
        "grades": 4,
        "attendance": 10,
    }
    assert store.read(1)["attendance"].count() == 8
    assert store.has_batch("first") and not store.has_batch("second")
    store.compact()
    assert store.version() == 3 and store.read()["attendance"].count() == 10


def test_changes_hold_for_rows_written_before(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "a store"))
    store.publish(replace=school)

    def change(*rows_):
        schema = "enrollment_id long, assessment_type string, new_score decimal(5,2), new_weight decimal(3,2)"
        return spark.createDataFrame([(*r[:2], *(None if x is None else D(x) for x in r[2:])) for r in rows_], schema)

    store.publish(changes=change((12, "Midterm", "10", None), (10, "Final", "20", "0.1")))
    late = school["grades"].where("grade_id = 102").selectExpr("grade_id + 10 as grade_id", "enrollment_id", "assessment_type", "score", "weight")
    store.publish(append={"grades": late})
    store.publish(changes=change((10, "Final", "30", "0.2")))
    want = [(100, D("80.00")), (101, D("30.00")), (102, D("10.00")), (103, D("10.00")), (112, D("59.99"))]
    assert rows(store.read()["grades"], "grade_id", "score") == want
    assert rows(store.read(2)["grades"].where("grade_id = 101"), "score") == [(D("20.00"),)]
    store.compact()
    assert rows(store.read()["grades"], "grade_id", "score") == want
    assert store.next_ids()["grades"] == 113


def test_a_publish_writes_only_its_own_lines(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace=school)
    one = school["attendance"].limit(1)
    sizes = []
    for _ in range(12):
        store.publish(append={"attendance": one})
        newest = max((tmp_path / "store" / "manifest").glob("*/part-*"), key=lambda p: p.stat().st_mtime_ns)
        sizes.append(newest.stat().st_size)
    assert max(sizes) - min(sizes) < 20
    assert store.read()["attendance"].count() == 20


def test_ids_are_not_given_again(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.next_ids()["students"] == 1
    store.publish(replace=school)
    store.publish(replace={"students": school["students"].where("student_id = 1")})
    assert store.next_ids() == {"students": 3, "courses": 4, "enrollments": 14, "grades": 104, "attendance": 9}


def test_failed_run_leaves_the_state(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace=school)
    sources = L.Sources(
        people=write_people(tmp_path),
        grades=write_grades(
            tmp_path,
            [{"student_ref_id": 1, "course_code_ref": "M1", "assessment": "F", "score": 150, "weight": 0.4}],
        ),
    )
    with pytest.raises(ValueError, match="score_out_of_range"):
        L.run_loads(spark, sources, store)
    assert store.version() == 1 and store.read()["students"].count() == 2
    with pytest.raises(ValueError, match="credits_bad_number"):
        L.run_loads(spark, L.Sources(catalog=catalog(spark, ("Word", "W1", "three"))), store)
    assert store.version() == 1


def test_full_run(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace=school)
    grades = [
        {"student_ref_id": s, "course_code_ref": c, "assessment": "Final Project", "score": 77.7, "weight": 0.4}
        for s, c in ((1, "R1"), (3, "M1"), (4, "M1"))
    ]
    sources = L.Sources(write_people(tmp_path), catalog(spark, *CATALOG), write_grades(tmp_path, grades))
    done = L.run_loads(spark, sources, store, "2024-06-01", batch="run")
    rejected = done.rejected
    assert done.counters == {
        "people": {"extracted": 5, "kept": 3, "processed": 3, "inserted": 1, "skipped": 2},
        "catalog": {"extracted": 2, "kept": 2, "processed": 2, "inserted": 2, "skipped": 0},
        "grades": {"extracted": 3, "added_enrollments": 2, "added_grades": 2, "student_not_found": 1},
    }
    version = store.version()
    assert L.run_loads(spark, sources, store, "2024-06-01", batch="run").counters == {} and store.version() == version
    now = store.read()
    assert rows(now["students"], "student_id", "email") == [(1, "ann@x"), (2, "bob@x"), (3, "cid@x")]
    assert rows(now["courses"], "course_code") == [("A1",), ("A2",), ("E1",), ("M1",), ("R1",)]
    assert rows(now["enrollments"].where("semester = 'External Transfer'"), "student_id", "course_id") == [(1, 4), (3, 1)]
    assert rows(rejected["grades"], "student_ref_id", "reasons") == [(4, ["student_not_found"])]
    assert now["grades"].where("score = 77.70").count() == 2


def test_seed_is_inserted_once(spark, school):
    once = L.seed(school, spark)
    twice = L.seed(once, spark)
    assert once["students"].count() == 3 and once["courses"].count() == 4
    assert twice["students"].count() == 3 and twice["courses"].count() == 4


def test_csv_export(spark, tmp_path, make, school):
    courses = make("courses", "course_id course_name course_code credits", [(1, 'The "big", one', "M1", 3)])
    t = A.transcripts(school["students"], courses, school["enrollments"], school["grades"])
    exports.export_csv(t.where("student_id = 1").coalesce(1), str(tmp_path / "one"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "one").glob("part-*")))
    lines = [ln for ln in text.decode().split("\r\n") if ln and not ln.startswith("Student ID")]
    assert b"Student ID,First,Last,Email,Code,Course,Credits,Semester,Avg Score,Grade\r\n" in text
    assert lines == [
        '1,Ann,Low,ann@x,M1,"The ""big"", one",3,Fall 2024,85.00,B',
        '1,Ann,Low,ann@x,M1,"The ""big"", one",3,Spring 2025,,N/A',
    ]
    exports.export_csv(t, str(tmp_path / "each"), per_student=True)
    assert {p.name for p in (tmp_path / "each").glob("student_id=*")} == {"student_id=1", "student_id=2"}


def test_text_export(spark, tmp_path, school):
    t = A.transcripts(*[school[n] for n in ("students", "courses", "enrollments", "grades")])
    exports.export_text(A.transcript_lines(t), str(tmp_path / "text"))
    files = sorted((tmp_path / "text").glob("part-*"))
    text = "".join(p.read_text() for p in files)
    assert text.splitlines()[:3] == ["TRANSCRIPT: Ann Low", "-" * 40, "Algebra                   | B"]
    exports.export_text(A.transcript_listing(t), str(tmp_path / "each"), per_student=True)
    assert (tmp_path / "each" / "student_id=2").exists()


def test_command_stream(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace=school)
    inbox = tmp_path / "in"
    inbox.mkdir()

    def send(name, *commands):
        (inbox / name).write_text("\n".join(json.dumps(c) for c in commands))

    def run():
        q = start_command_stream(spark, str(inbox), store, "record_grades", str(tmp_path / "checkpoint"))
        q.awaitTermination()
        return store.version()

    call = {"email": "ann@x", "course_code": "M1", "assessment": "Project"}
    send("1.json", {"seq": 1, "score": "50", "weight": "0.2", **call}, {"seq": 2, "score": "x", "weight": "0.2", **call})
    assert run() == 2
    send("2.json", {"seq": 3, "score": "61", "weight": "0.2", **call})
    assert run() == 3
    assert run() == 3
    got = rows(store.read()["grades"].where("assessment_type = 'Project'"), "grade_id", "score")
    assert got == [(104, D("61.00"))]


def test_batch_played_again_changes_nothing(spark, tmp_path, school):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace=school)
    calls = spark.createDataFrame(
        [(1, "ann@x", "M1", "Late")], "seq long, email string, course_code string, status string"
    )
    for _ in range(2):
        apply_batch(store, "mark_attendance", calls, "b-1", "2024-06-01")
    assert store.read()["attendance"].count() == 9
    with pytest.raises(ValueError, match="unknown verb"):
        apply_batch(store, "expel", calls, "b-2")


@pytest.mark.parametrize("max_files", [1, 1000])
def test_outcome_does_not_depend_on_batches(spark, tmp_path, school, max_files):
    store = TableStore(spark, str(tmp_path / "a store"))  # a blank in the path
    store.publish(replace=school)
    inbox = tmp_path / "in"
    inbox.mkdir()
    call = {"email": "ann@x", "course_code": "M1", "assessment": "Midterm", "weight": "0.2"}
    for i, (seq, score) in enumerate(((2, "90"), (1, "50"), (7, "60"))):
        path = inbox / f"{9 - i}.json"
        path.write_text(json.dumps({"seq": seq, "score": score, **call}))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    start_command_stream(spark, str(inbox), store, "record_grades", str(tmp_path / "c"), max_files=max_files).awaitTermination()
    got = store.read()["grades"].where("enrollment_id = 10 and assessment_type = 'Midterm'")
    assert rows(got, "score") == [(D("60.00"),)]
