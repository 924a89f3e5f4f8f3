"""Pages of the activity listing, and transcripts packed into few files."""

from __future__ import annotations

import itertools

import pytest

from rollbook.plans import pages
from rollbook.plans import reports as A
from rollbook.sources import exports

from .conftest import rows


def listing(t):
    """The whole listing, by hand."""
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    names = {s.student_id: s for s in t["students"].collect()}
    codes = {c.course_id: c.course_code for c in t["courses"].collect()}
    out = []
    for e in sorted(t["enrollments"].collect(), key=lambda e: e.enrollment_id):
        own = lambda name, *cols: sorted((tuple(r[c] for c in cols) for r in t[name].collect() if r.enrollment_id == e.enrollment_id), key=key)  # noqa: E731, B023
        marks, days = own("grades", "assessment_type", "score") or [(None, None)], own("attendance", "attendance_date", "status") or [(None, None)]
        s = names[e.student_id]
        for m, d in itertools.product(marks, days):
            out.append((len(out), e.enrollment_id, s.first_name, s.last_name, codes[e.course_id], *m, d[1], d[0]))
    return out


@pytest.mark.parametrize("first,last", [(0, 100), (3, 9), (8, 9), (20, 30)])
def test_a_page_is_a_stretch_of_the_listing(school, first, last):
    got = pages.activity_page(*(school[n] for n in ("students", "courses", "enrollments", "grades", "attendance")), first, last)
    assert sorted(tuple(r) for r in got.collect()) == listing(school)[first:last]


def test_packed_files(spark, tmp_path, make, school):
    people = [(i, f"Änn {i}", 'Lo,w "q"', f"{i}@x", "Math") for i in range(1, 60)]
    students = make("students", "student_id first_name last_name email major", people)
    entered = [(i, i, 1 + i % 3, "Fall 2024", "2024-09-01") for i in range(1, 60)] + [(100 + i, 7, 1, f"S{i}", "2024-09-01") for i in range(200)]
    enrollments = make("enrollments", "enrollment_id student_id course_id semester enrollment_date", entered)
    papers = A.transcripts(students, school["courses"], enrollments, school["grades"])
    exports.export_packed(papers, str(tmp_path / "packed"))
    assert len(list((tmp_path / "packed" / "files").glob("part=*/part-*"))) <= 2
    got = dict(rows(exports.read_packed(spark, str(tmp_path / "packed"), students)))
    assert set(got) == set(range(1, 60))
    for i in (5, 7):
        lines = got[i].split("\r\n")
        want = sorted(r.course_code + r.semester for r in papers.where(f"student_id = {i}").collect())
        assert lines[0] == ",".join(exports.CSV_HEADER.values()) and lines[-1] == "" and len(lines) == len(want) + 2
        assert all(line.startswith(f'{i},Änn {i},"Lo,w ""q""",{i}@x,') for line in lines[1:-1])
