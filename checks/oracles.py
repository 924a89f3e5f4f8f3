"""DuckDB statements the registered queries are checked against.

They follow the flat form of each report (join first, aggregate last), not the
pre-aggregated plans of the library.
"""

from __future__ import annotations

from checks.fixtures import LINE_ORDER, with_views
from rollbook.functions.text import NA_TOKENS

_S = "sum(cast(score * 100 as bigint))"
_N = "count(score)"
_TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)
_EPOCH = "cast('2024-06-01' as date)"


def _mean(s: str = _S, n: str = _N) -> str:
    return f"case when {n} > 0 then cast(cast((2 * {s} + {n}) // (2 * {n}) as bigint) / 100.0 as decimal(5,2)) end"


def _band(bands: list[tuple[int, str]], otherwise: str, s: str = _S, n: str = _N) -> str:
    whens = " ".join(f"when {s} >= {floor * 100} * {n} then '{name}'" for floor, name in bands)
    return f"case when {n} = 0 then '{otherwise}' {whens}"


_TIER = _band([(90, "Excellent"), (75, "Good"), (60, "Average")], "Needs Improvement") + " else 'Needs Improvement' end"

# Each enrollment with the sum of its scores in hundredths and how many there are.
_MARKED = """
  SELECT enrollment_id, student_id, course_id, semester,
         coalesce((SELECT sum(cast(score * 100 as bigint)) FROM grades WHERE grades.enrollment_id = enrollments.enrollment_id), 0)
           AS points,
         (SELECT count(score) FROM grades WHERE grades.enrollment_id = enrollments.enrollment_id) AS marks
  FROM enrollments
"""
_VIEW = f"""
  SELECT student_id, first_name, last_name, email, course_code, course_name, credits, semester,
         {_mean("points", "marks")} AS final_score,
         {_band([(90, "A"), (80, "B"), (70, "C"), (60, "D")], "N/A", "points", "marks")} else 'F' end AS letter_grade
  FROM (SELECT student_id, course_id, semester, sum(points) AS points, sum(marks) AS marks
        FROM ({_MARKED}) GROUP BY student_id, course_id, semester)
  JOIN students USING (student_id) JOIN courses USING (course_id)
"""


def _stats(attendance: str = "attendance") -> str:
    return f"""
  SELECT student_id, course_id, cast(sum(held) as bigint) AS total_classes, cast(sum(came) as bigint) AS classes_attended
  FROM enrollments JOIN (
    SELECT enrollment_id, count(*) AS held, count(*) FILTER (status IN ('Late', 'Present')) AS came
    FROM {attendance} GROUP BY enrollment_id) USING (enrollment_id)
  GROUP BY student_id, course_id
"""


def _of(column: str, table: str, key: str) -> str:
    """A looked-up value of the row at hand."""
    return f"(SELECT any_value({column}) FROM {table} t WHERE t.{key} = low.{key}) AS {column}"


_FOUR = ("students", "courses", "enrollments", "grades")
_FIVE = (*_FOUR, "attendance")


def _risk(attendance: str) -> str:
    return f"""
    , low AS (SELECT * FROM ({_stats(attendance)}) WHERE 4 * classes_attended < 3 * total_classes
              AND student_id IN (SELECT student_id FROM students) AND course_id IN (SELECT course_id FROM courses))
    SELECT {_of("first_name", "students", "student_id")}, {_of("last_name", "students", "student_id")},
           {_of("course_code", "courses", "course_id")}, classes_attended, total_classes,
           cast((2000 * classes_attended + total_classes) // (2 * total_classes) / 10.0 as decimal(4,1)) AS attendance_pct
    FROM low
    """


def _best(points: str, least: int, mean: str, *names: str) -> str:
    """The ten best students of rows (student_id, points, marks), names looked up last."""
    looked_up = ", ".join(_of(n, "students", "student_id") for n in names)
    return f"""
    , low AS (SELECT student_id, {_mean("sum(points)", "sum(marks)")} AS {mean} FROM ({points})
              WHERE student_id IN (SELECT student_id FROM students)
              GROUP BY student_id HAVING sum(marks) >= {least} {_TOP.format(m=mean)})
    SELECT student_id, {looked_up}, {mean} FROM low
    """


def _lines(title: str, second: str, body: str) -> str:
    return f"""
    , view AS ({_VIEW}),
    heads AS (SELECT DISTINCT student_id, concat(first_name, ' ', last_name) AS name FROM view)
    SELECT student_id, 0 AS block, '' AS course_code, '' AS semester, concat('{title}: ', name) AS line FROM heads
    UNION ALL SELECT student_id, 1, '', '', '{second}' FROM heads
    UNION ALL SELECT student_id, 2, course_code, coalesce(semester, ''), {body} FROM view
    """


_REASONS = """concat_ws(',',
    case when assessment is null then 'assessment_missing' end,
    case when length(rtrim(assessment)) > 50 then 'assessment_too_long' end,
    case when try_cast(score as decimal(5,2)) is null then 'score_bad_number' end,
    case when not (try_cast(score as decimal(5,2)) between 0 and 100) then 'score_out_of_range' end,
    case when try_cast(weight as decimal(3,2)) is null then 'weight_bad_number' end,
    case when not regexp_matches(entry_date, '^\\d{4}-\\d{2}-\\d{2}') then 'entry_date_bad_shape' end,
    case when try_cast(entry_date as date) is null then 'entry_date_not_a_date' end,
    case when status not in ('Present', 'Absent', 'Late', 'Excused') then 'status_not_allowed' end,
    case when credits <= 0 then 'credits_not_positive' end)"""

_PERSON_PER_ORDER = """
    , batch AS (SELECT o.o_orderkey AS seq, s.email, s.first_name, s.last_name, o.priority AS major
                FROM orders_placed o JOIN students s ON o.student_id = s.student_id WHERE s.email IS NOT NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY email ORDER BY seq) AS rn FROM batch),
    new AS (SELECT seq, email, first_name, last_name, major FROM ranked
            WHERE rn = 1 AND email NOT IN (SELECT email FROM held_students WHERE email IS NOT NULL))
"""
_PEOPLE_VIEWS = ("orders_placed", "students", "held_students")

_FEED = """
    , feed AS (SELECT o.student_id, concat('P', cast(case when l.l_linenumber <= 3 then o.course_id
                 else l.l_partkey + 50 end as varchar)) AS code, l.assessment_type, l.score, l.weight
               FROM lines l JOIN orders_placed o ON l.l_orderkey = o.o_orderkey),
    known AS (SELECT f.*, c.course_id FROM feed f
              JOIN students s ON s.student_id = f.student_id AND s.email IS NOT NULL
              JOIN courses c ON c.course_code = f.code),
    old AS (SELECT student_id, course_id, min(enrollment_id) AS enrollment_id FROM enrollments GROUP BY 1, 2),
    fresh AS (SELECT student_id, course_id,
                     (SELECT max(enrollment_id) FROM enrollments)
                       + row_number() OVER (ORDER BY student_id, course_id) AS enrollment_id
              FROM (SELECT DISTINCT student_id, course_id FROM known) k
              WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.student_id = k.student_id AND o.course_id = k.course_id)),
    ids AS (SELECT o.student_id, o.course_id, o.enrollment_id, e.semester
            FROM old o JOIN enrollments e ON o.enrollment_id = e.enrollment_id
            UNION ALL SELECT student_id, course_id, enrollment_id, 'External Transfer' FROM fresh)
    SELECT cast(i.enrollment_id as bigint) AS enrollment_id, k.student_id, k.course_id, i.semester, k.assessment_type,
           k.score, k.weight, cast(null as varchar) AS course_code_ref, cast(null as varchar) AS reasons
    FROM known k JOIN ids i ON i.student_id = k.student_id AND i.course_id = k.course_id
    UNION ALL
    SELECT null, f.student_id, null, null, null, f.score, null, f.code,
           case when s.student_id is null then 'student_not_found' else 'course_not_found' end
    FROM feed f LEFT JOIN students s ON s.student_id = f.student_id AND s.email IS NOT NULL
    LEFT JOIN courses c ON c.course_code = f.code
    WHERE s.student_id IS NULL OR c.course_id IS NULL
"""
_FEED_VIEWS = ("lines", "orders_placed", "students", "courses", "enrollments")

_ORDER_DESC = ", ".join(f"{c} DESC" for c in LINE_ORDER)

_PEOPLE_KEPT = f"email IS NOT NULL AND email NOT IN ({_TOKENS})"

_CALLS = """
    , calls AS (SELECT m.*, s.email, c.course_code, c.course_id, s.student_id
                FROM event_rows m JOIN orders_placed o ON m.enrollment_id = o.o_orderkey
                JOIN students s ON s.student_id = o.student_id JOIN courses c ON c.course_id = o.course_id),
    first AS (SELECT student_id, course_id, min(enrollment_id) AS enrollment_id FROM enrollments GROUP BY 1, 2),
    linked AS (SELECT k.seq, k.attendance_date, k.status, k.email, f.enrollment_id
               FROM calls k JOIN first f ON f.student_id = k.student_id AND f.course_id = k.course_id)
"""
_CALL_VIEWS = ("event_rows", "orders_placed", "students", "courses", "enrollments")

_TOP = "ORDER BY {m} DESC NULLS FIRST, student_id LIMIT 10"


def statements() -> dict[str, str]:
    out: dict[str, str] = {}

    out["course_performance"] = with_views(
        f"""
        SELECT c.course_code, c.course_name, count(*) AS total_assessments,
               {_mean()} AS average_score, {_TIER} AS performance_category
        FROM courses c JOIN enrollments e ON c.course_id = e.course_id
        JOIN grades g ON e.enrollment_id = g.enrollment_id
        GROUP BY c.course_id, c.course_code, c.course_name
        """,
        "courses",
        "enrollments",
        "grades",
    )
    out["transcripts"] = with_views(_VIEW, *_FOUR)
    out["transcripts_for_requests"] = with_views(
        f"""
        , view AS ({_VIEW}), stats AS ({_stats()})
        SELECT * FROM view WHERE email IN (
          SELECT s.email FROM students s JOIN stats t ON s.student_id = t.student_id
          WHERE 4 * t.classes_attended < 3 * t.total_classes AND s.email IS NOT NULL
          UNION ALL SELECT email FROM strangers)
        """,
        *_FIVE,
        "strangers",
    )
    out["deans_list"] = with_views(
        _best(_MARKED, 3, "overall_gpa", "first_name", "last_name", "major"), "students", "enrollments", "grades"
    )
    finals = f"SELECT student_id, cast(final_score * 100 as bigint) AS points, (final_score is not null)::int AS marks FROM ({_VIEW})"
    out["deans_list_by_course"] = with_views(_best(finals, 4, "gpa", "first_name", "last_name"), *_FOUR)
    out["attendance_stats"] = with_views(", stats AS (" + _stats() + ") SELECT * FROM stats", "attendance", "enrollments")
    out["at_risk"] = with_views(_risk("attendance"), "attendance", "enrollments", "students", "courses")
    out["popularity"] = with_views(
        """
        , counted AS (SELECT course_id, semester, count(student_id) AS n FROM enrollments GROUP BY course_id, semester),
        unused AS (SELECT course_id, cast(null as varchar) AS semester, 0 AS n FROM courses
                   WHERE course_id NOT IN (SELECT course_id FROM enrollments WHERE course_id IS NOT NULL))
        SELECT course_name, semester, cast(sum(n) as bigint) AS total_students
        FROM (SELECT * FROM counted UNION ALL SELECT * FROM unused) JOIN courses USING (course_id)
        GROUP BY course_name, semester
        """,
        "courses",
        "enrollments",
    )
    out["activity_log"] = with_views(
        """
        , sizes AS (SELECT enrollment_id, student_id, course_id,
                      (SELECT count(*) FROM grades WHERE grades.enrollment_id = enrollments.enrollment_id) AS m,
                      (SELECT count(*) FROM attendance WHERE attendance.enrollment_id = enrollments.enrollment_id) AS n
                    FROM enrollments),
        named AS (SELECT enrollment_id, first_name, last_name, course_code, m, n
                  FROM sizes JOIN students USING (student_id) JOIN courses USING (course_id)),
        marks AS (SELECT enrollment_id, 'grade' AS kind, assessment_type, score, null AS status, null AS attendance_date,
                         count(*) AS k FROM grades GROUP BY enrollment_id, assessment_type, score),
        days AS (SELECT enrollment_id, 'attendance', null, null, status, attendance_date, count(*)
                 FROM attendance GROUP BY enrollment_id, status, attendance_date)
        SELECT enrollment_id, first_name, last_name, course_code, kind, assessment_type, score,
               cast(status as varchar) AS status, cast(attendance_date as date) AS attendance_date,
               k * greatest(1, if(kind = 'grade', n, m)) AS times
        FROM (SELECT * FROM marks UNION ALL SELECT * FROM days) JOIN named USING (enrollment_id)
        UNION ALL SELECT enrollment_id, first_name, last_name, course_code, 'none', null, null, null, null, 1
        FROM named WHERE m = 0 AND n = 0
        """,
        *_FIVE,
    )
    out["packed_transcripts"] = with_views(
        f"""
        , papers AS ({_VIEW}),
        lines AS (SELECT *, concat_ws(',', student_id, first_name, last_name, coalesce(email, ''), course_code, course_name, credits,
                    semester, coalesce(cast(final_score AS varchar), ''), letter_grade) || chr(13) || chr(10) AS line FROM papers)
        SELECT student_id, 'Student ID,First,Last,Email,Code,Course,Credits,Semester,Avg Score,Grade' || chr(13) || chr(10)
          || string_agg(line, '' ORDER BY course_code, semester) AS csv
        FROM lines WHERE student_id IN (SELECT student_id FROM debtors) GROUP BY student_id
        """,
        *_FOUR,
        "debtors",
    )
    out["activity_page"] = with_views(
        """
        , marks AS (SELECT enrollment_id, assessment_type, score, row_number() OVER (PARTITION BY enrollment_id
                      ORDER BY assessment_type NULLS FIRST, score NULLS FIRST) AS mark FROM grades),
        product AS (SELECT enrollment_id, first_name, last_name, course_code, assessment_type, score, status, attendance_date, mark
                    FROM enrollments JOIN students USING (student_id) JOIN courses USING (course_id)
                    LEFT JOIN marks USING (enrollment_id) LEFT JOIN attendance USING (enrollment_id)),
        numbered AS (SELECT row_number() OVER (ORDER BY enrollment_id, mark, attendance_date NULLS FIRST, status NULLS FIRST) - 1
                       AS row, * EXCLUDE (mark) FROM product)
        SELECT * FROM numbered WHERE row BETWEEN 1000 AND 3999
        """,
        *_FIVE,
    )
    out["transcript_text"] = with_views(
        _lines(
            "TRANSCRIPT",
            "-" * 40,
            "concat(rpad(course_name, cast(greatest(25, length(course_name)) as int), ' '), ' | ', letter_grade)",
        ),
        *_FOUR,
    )
    out["transcript_listing"] = with_views(
        _lines(
            "Official Transcript",
            "Course Code | Course Name | Score | Grade",
            "concat(course_code, ' | ', course_name, ' | ', coalesce(cast(final_score as varchar), 'None'), "
            "' | ', letter_grade)",
        ),
        *_FOUR,
    )
    out["transcript_csv"] = with_views(
        f"""
        , view AS ({_VIEW})
        SELECT cast(student_id as varchar) AS student_id, first_name, last_name, email, course_code, course_name,
               cast(credits as varchar) AS credits, semester, cast(final_score as varchar) AS final_score, letter_grade
        FROM view
        """,
        *_FOUR,
    )
    out["sql_views"] = with_views(
        f"""
        , view AS ({_VIEW}), stats AS ({_stats()})
        SELECT t.letter_grade, t.semester, count(*) AS transcripts, count(DISTINCT t.student_id) AS students,
               cast(sum(a.total_classes) as bigint) AS classes
        FROM view t JOIN courses c ON t.course_code = c.course_code
        LEFT JOIN stats a ON a.student_id = t.student_id AND a.course_id = c.course_id
        GROUP BY t.letter_grade, t.semester
        """,
        *_FIVE,
    )

    out["clean_people"] = with_views(
        f"""
        SELECT first_name, last_name, email, try_cast(dob as date) AS date_of_birth, major,
               concat(lower(first_name), '.', replace(lower(last_name), ' ', ''), length(email), '@campus.example')
                 AS derived_email
        FROM people_feed WHERE {_PEOPLE_KEPT}
        """,
        "people_feed",
    )
    out["rule_rejects"] = with_views(
        f", judged AS (SELECT *, {_REASONS} AS reasons FROM entries) SELECT * FROM judged WHERE reasons <> ''",
        "entries",
    )
    out["valid_entries"] = with_views(
        f"""
        , judged AS (SELECT *, {_REASONS} AS reasons FROM entries)
        SELECT enrollment_id,
               case when length(assessment) > 50 then left(assessment, 50) else assessment end AS assessment_type,
               cast(score as decimal(5,2)) AS score, cast(weight as decimal(3,2)) AS weight,
               cast(entry_date as date) AS attendance_date, status, credits
        FROM judged WHERE reasons = '' AND cast(score as double) BETWEEN 0 AND 100
        """,
        "entries",
    )
    out["schema_evolution"] = with_views(
        f"""
        SELECT s.student_id, s.first_name, s.last_name, s.email, s.major, cast(null as date) AS date_of_birth,
               cast(null as varchar) AS phone_number, e.enrollment_id, e.semester, {_EPOCH} AS enrollment_date
        FROM students s JOIN enrollments e ON s.student_id = e.student_id
        """,
        "students",
        "enrollments",
    )

    out["insert_new_students"] = with_views(_PERSON_PER_ORDER + "SELECT * FROM new", *_PEOPLE_VIEWS)
    out["skipped_students"] = with_views(
        _PERSON_PER_ORDER + "SELECT * FROM batch WHERE seq NOT IN (SELECT seq FROM new)", *_PEOPLE_VIEWS
    )
    out["assign_ids"] = with_views(
        _PERSON_PER_ORDER
        + """SELECT cast((SELECT max(student_id) FROM held_students) + row_number() OVER (ORDER BY seq) as bigint)
             AS student_id, email FROM new""",
        *_PEOPLE_VIEWS,
    )
    out["insert_new_courses"] = with_views(
        """
        , batch AS (SELECT seq, course_name, course_code, credits FROM course_offers
                    UNION ALL SELECT seq, course_name, course_code, credits FROM course_offers_again
                    UNION ALL SELECT -1, 'Intro to Data Engineering', 'DE101', 3),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY course_code ORDER BY seq) AS rn FROM batch)
        SELECT course_name, course_code, credits FROM ranked
        WHERE rn = 1 AND course_code NOT IN (SELECT course_code FROM held_courses)
        """,
        "course_offers",
        "course_offers_again",
        "held_courses",
    )
    out["insert_enrollments"] = with_views(
        """
        , batch AS (SELECT o.student_id, o.course_id,
                      case when o.o_orderkey % 53 = 0 then null else o.semester end AS semester,
                      l.ship_date AS enrollment_date
                    FROM lines l JOIN orders_placed o ON l.l_orderkey = o.o_orderkey)
        SELECT student_id, course_id, semester, min(enrollment_date) AS enrollment_date
        FROM batch b WHERE semester IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM held_enrollments h WHERE h.student_id = b.student_id AND h.course_id = b.course_id
          AND h.semester = b.semester)
        GROUP BY student_id, course_id, semester
        UNION ALL SELECT * FROM batch WHERE semester IS NULL
        """,
        "lines",
        "orders_placed",
        "held_enrollments",
    )
    kept = f"(SELECT * FROM people_feed WHERE {_PEOPLE_KEPT})"
    fresh = f"{kept} k WHERE email NOT IN (SELECT email FROM held_students WHERE email IS NOT NULL)"
    out["load_counters"] = with_views(
        f"""
        SELECT 'extracted' AS metric, count(*) AS "rows" FROM people_feed
        UNION ALL SELECT 'kept', count(*) FROM {kept}
        UNION ALL SELECT 'processed', count(*) FROM {kept}
        UNION ALL SELECT 'inserted', count(*) FROM {fresh}
        UNION ALL SELECT 'skipped', (SELECT count(*) FROM {kept}) - (SELECT count(*) FROM {fresh})
        """,
        "people_feed",
        "held_students",
    )

    out["orphans"] = with_views(
        """
        SELECT g.* FROM loose_grades g LEFT JOIN enrollments e ON g.enrollment_id = e.enrollment_id
        WHERE g.enrollment_id IS NOT NULL AND e.enrollment_id IS NULL
        """,
        "loose_grades",
        "enrollments",
    )
    out["duplicate_keys"] = with_views(
        """
        SELECT enrollment_id, assessment_type, count(*) AS copies FROM loose_grades
        WHERE enrollment_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
        """,
        "loose_grades",
    )
    out["cascade_delete"] = with_views(
        """
        , gone AS (SELECT enrollment_id FROM enrollments WHERE course_id IN (SELECT course_id FROM small_courses))
        SELECT 'students' AS "table", count(*) AS kept, cast(0 as bigint) AS deleted FROM students
        UNION ALL SELECT 'courses', count(*) - (SELECT count(*) FROM small_courses),
                         (SELECT count(*) FROM small_courses) FROM courses
        UNION ALL SELECT 'enrollments', count(*) - (SELECT count(*) FROM gone), (SELECT count(*) FROM gone)
                  FROM enrollments
        UNION ALL SELECT 'grades', count(*) FILTER (enrollment_id NOT IN (SELECT enrollment_id FROM gone)),
                         count(*) FILTER (enrollment_id IN (SELECT enrollment_id FROM gone)) FROM grades
        UNION ALL SELECT 'attendance', count(*) FILTER (enrollment_id NOT IN (SELECT enrollment_id FROM gone)),
                         count(*) FILTER (enrollment_id IN (SELECT enrollment_id FROM gone)) FROM attendance
        """,
        *_FIVE,
        "small_courses",
    )
    out["delete_students"] = with_views(
        """
        , asked AS (SELECT email FROM debtors UNION ALL SELECT email FROM strangers)
        SELECT g.enrollment_id, g.assessment_type, g.score, cast(null as varchar) AS email,
               cast(null as varchar) AS reasons
        FROM grades g JOIN enrollments e ON g.enrollment_id = e.enrollment_id
        JOIN students s ON s.student_id = e.student_id
        WHERE s.email IS NULL OR s.email NOT IN (SELECT email FROM asked WHERE email IS NOT NULL)
        UNION ALL SELECT null, null, null, a.email, 'student_not_found'
        FROM asked a LEFT JOIN students s ON a.email = s.email WHERE s.student_id IS NULL
        """,
        *_FOUR,
        "debtors",
        "strangers",
    )

    out["add_students"] = with_views(
        """
        , calls AS (SELECT o.o_orderkey AS seq, s.email,
                      case when o.o_orderkey % 31 = 0 then '9999-99-99' when o.o_orderkey % 37 = 0 then '24-1-1'
                           else cast(o.placed as varchar) end AS dob
                    FROM orders_placed o JOIN students s ON o.student_id = s.student_id WHERE s.email IS NOT NULL),
        judged AS (SELECT *, case when not regexp_matches(dob, '^\\d{4}-\\d{2}-\\d{2}') then 'dob_bad_shape'
                                  when try_cast(dob as date) is null then 'dob_not_a_date' end AS why FROM calls),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY email, why IS NULL ORDER BY seq) AS rn,
                     email IN (SELECT email FROM held_students WHERE email IS NOT NULL) AS held FROM judged),
        accepted AS (SELECT * FROM ranked WHERE why IS NULL AND rn = 1 AND NOT held)
        SELECT cast((SELECT max(student_id) FROM held_students) + row_number() OVER (ORDER BY seq) as bigint)
                 AS student_id, email, cast(dob as date) AS date_of_birth, cast(null as bigint) AS seq,
               cast(null as varchar) AS reasons
        FROM accepted
        UNION ALL SELECT null, email, null, seq, coalesce(why, 'duplicate_email') FROM ranked
        WHERE seq NOT IN (SELECT seq FROM accepted)
        """,
        *_PEOPLE_VIEWS,
    )
    out["register_students"] = with_views(
        f"""
        , calls AS (SELECT o.o_orderkey AS seq,
                      case when o.o_orderkey % 59 = 0 then 'x' || s.email else s.email end AS email,
                      concat('P', cast(cast(floor(o.o_orderkey / 7) as bigint) as varchar)) AS course_code,
                      case when o.o_orderkey % 53 = 0 then 'Spring of a year long ago' else o.semester end AS semester
                    FROM orders_placed o JOIN students s ON o.student_id = s.student_id),
        judged AS (SELECT k.*, s.student_id, c.course_id,
                     case when s.student_id is null then 'student_not_found'
                          when c.course_id is null then 'course_not_found'
                          when length(rtrim(k.semester)) > 20 then 'semester_too_long' end AS why
                   FROM calls k LEFT JOIN students s ON k.email = s.email
                   LEFT JOIN courses c ON k.course_code = c.course_code),
        firsts AS (SELECT student_id, course_id, semester, min(seq) AS seq FROM judged j WHERE why IS NULL
                   AND NOT EXISTS (SELECT 1 FROM held_enrollments h WHERE h.student_id = j.student_id
                                   AND h.course_id = j.course_id AND h.semester = j.semester)
                   GROUP BY 1, 2, 3)
        SELECT cast((SELECT max(enrollment_id) FROM held_enrollments) + row_number() OVER (ORDER BY seq) as bigint)
                 AS enrollment_id, student_id, course_id, {_EPOCH} AS enrollment_date, semester,
               cast(null as bigint) AS seq, cast(null as varchar) AS email, cast(null as varchar) AS course_code,
               cast(null as varchar) AS reasons
        FROM firsts
        UNION ALL SELECT null, null, null, null, null, seq, email, course_code, why FROM judged WHERE why IS NOT NULL
        """,
        "orders_placed",
        "students",
        "courses",
        "held_enrollments",
    )
    out["record_grades"] = with_views(
        f"""
        , calls AS (SELECT l.*, o.student_id, o.course_id, s.email, c.course_code,
                      case when l.l_partkey % 97 = 0 then '100.004' when l.l_partkey % 101 = 0 then 'n/a'
                           when l.l_partkey % 103 = 0 then '88d' when l.l_partkey % 107 = 0 then '0x1p3'
                           when l.l_partkey % 109 = 0 then null else cast(l.score as varchar) end AS text,
                      case when l.l_partkey % 83 = 0 then null when l.l_partkey % 89 = 0 then '12.5'
                           else cast(l.weight as varchar) end AS part
                    FROM lines l JOIN orders_placed o ON l.l_orderkey = o.o_orderkey
                    JOIN students s ON s.student_id = o.student_id JOIN courses c ON c.course_id = o.course_id
                    WHERE l.l_linenumber > 4),
        first AS (SELECT student_id, course_id, min(enrollment_id) AS enrollment_id FROM enrollments GROUP BY 1, 2),
        judged AS (SELECT k.*, f.enrollment_id,
                     case when text is null then 'score_missing'
                          when try_cast(text as double) is null then 'score_bad_number'
                          when not (try_cast(text as double) between 0 and 100) then 'score_out_of_range'
                          when k.email is null then 'enrollment_not_found'
                          when part is not null and try_cast(part as decimal(3,2)) is null then 'weight_bad_number'
                     end AS why
                   FROM calls k LEFT JOIN first f ON f.student_id = k.student_id AND f.course_id = k.course_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY enrollment_id, assessment_type
                                                ORDER BY {_ORDER_DESC}) AS rn FROM judged WHERE why IS NULL),
        changes AS (SELECT enrollment_id, assessment_type, cast(text as decimal(5,2)) AS score,
                           cast(part as decimal(3,2)) AS weight FROM ranked WHERE rn = 1),
        held AS (SELECT l_orderkey AS enrollment_id, assessment_type, score, weight FROM lines WHERE l_linenumber <= 4)
        SELECT h.enrollment_id, h.assessment_type, case when c.enrollment_id is null then h.score else c.score end
                 AS score, case when c.enrollment_id is null then h.weight else c.weight end AS weight,
               cast(null as varchar) AS email, cast(null as varchar) AS course_code, cast(null as varchar) AS reasons
        FROM held h LEFT JOIN changes c ON h.enrollment_id = c.enrollment_id AND h.assessment_type = c.assessment_type
        UNION ALL SELECT c.enrollment_id, c.assessment_type, c.score, c.weight, null, null, null FROM changes c
        WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.enrollment_id = c.enrollment_id
                          AND h.assessment_type = c.assessment_type)
        UNION ALL SELECT null, assessment_type, score, null, email, course_code, why FROM judged WHERE why IS NOT NULL
        """,
        "lines",
        "orders_placed",
        "students",
        "courses",
        "enrollments",
    )
    out["mark_attendance"] = with_views(
        _CALLS
        + """
        , judged AS (SELECT *, case when status = 'Here' then 'status_not_allowed'
                                    when email is null then 'enrollment_not_found' end AS why FROM linked)
        SELECT cast((SELECT max(attendance_id) FROM attendance) + row_number() OVER (ORDER BY seq) as bigint)
                 AS attendance_id, enrollment_id, attendance_date, status, cast(null as bigint) AS seq,
               cast(null as varchar) AS reasons FROM judged WHERE why IS NULL
        UNION ALL SELECT null, null, null, status, seq, why FROM judged WHERE why IS NOT NULL
        """,
        *_CALL_VIEWS,
        "attendance",
    )
    out["command_stream"] = with_views(
        _CALLS
        + f"""SELECT enrollment_id, {_EPOCH} AS attendance_date, status FROM linked
              WHERE status <> 'Here' AND email IS NOT NULL""",
        *_CALL_VIEWS,
    )
    out["grade_feed_load"] = with_views(_FEED, *_FEED_VIEWS)
    out["grade_json_load"] = out["grade_feed_load"]
    odd = "case when l.score >= 70 then concat(l.assessment_type, ' }\"{') else l.assessment_type end AS assessment_type, l.score"
    out["grade_array_load"] = with_views(_FEED.replace("l.assessment_type, l.score", odd), *_FEED_VIEWS)
    out["seed_tables"] = with_views(
        """
        , people AS (SELECT student_id, first_name, last_name, email, major FROM students),
        offers AS (SELECT course_id, course_name, course_code, credits FROM courses)
        SELECT *, NULL AS course_id, NULL AS course_name, NULL AS course_code, NULL AS credits FROM (
          SELECT * FROM people UNION ALL SELECT (SELECT max(student_id) + 1 FROM people), 'John', 'Doe', 'john.doe@example.com',
            'Computer Science' WHERE 'john.doe@example.com' NOT IN (SELECT email FROM people WHERE email IS NOT NULL))
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, * FROM (
          SELECT * FROM offers UNION ALL SELECT (SELECT max(course_id) + 1 FROM offers), 'Intro to Data Engineering', 'DE101', 3
          WHERE 'DE101' NOT IN (SELECT course_code FROM offers))
        """,
        "students",
        "courses",
    )
    out["people_csv_load"] = with_views(
        f"""
        , kept AS (SELECT *, case when try_cast(dob as date) is null then 'date_of_birth_not_a_date' end AS why
                   FROM people_feed WHERE {_PEOPLE_KEPT})
        SELECT first_name, last_name, email, cast(dob as date) AS date_of_birth,
               case when seq % 19 = 0 then concat(major, chr(10), major) else major end AS major,
               cast(null as varchar) AS reasons
        FROM kept WHERE why IS NULL AND email NOT IN (SELECT email FROM held_students WHERE email IS NOT NULL)
        UNION ALL SELECT null, null, email, null, null, why FROM kept WHERE why IS NOT NULL
        """,
        "people_feed",
        "held_students",
    )
    out["catalog_load"] = with_views(
        """
        , offers AS (SELECT * FROM course_offers UNION ALL SELECT seq + 100000000, course_name, course_code, credits
                     FROM course_offers),
        told AS (SELECT seq, course_name, if(seq % 23 = 0, null, course_code) AS course_code,
                   case when seq % 7 = 0 then 'three' when seq % 11 = 0 then '3.7' when seq % 13 = 0 then '0'
                        when seq % 17 = 0 then null else cast(credits as varchar) end AS credits FROM offers),
        judged AS (SELECT *, concat_ws(',', if(course_code is null, 'course_code_missing', null),
                     if(credits = '0', 'credits_not_positive', null),
                     if(credits in ('three', '3.7'), 'credits_bad_number', null)) AS reasons FROM told),
        firsts AS (SELECT course_code, min(seq) AS seq FROM judged WHERE reasons = ''
                   AND course_code NOT IN (SELECT course_code FROM held_courses) GROUP BY course_code)
        SELECT j.course_code, course_name, cast(credits as int) AS credits, cast(null as bigint) AS seq,
               cast(null as varchar) AS reasons FROM judged j JOIN firsts f ON j.seq = f.seq
        UNION ALL SELECT null, null, null, seq, reasons FROM judged WHERE reasons <> ''
        """,
        "course_offers",
        "held_courses",
    )
    out["grade_stream"] = with_views(
        """
        , calls AS (SELECT student_id, course_id, assessment_type, score, weight,
                      l_orderkey * 100000000 + l_partkey * 10 + l_linenumber AS seq
                    FROM lines JOIN orders_placed ON l_orderkey = o_orderkey
                    WHERE student_id IN (SELECT student_id FROM students WHERE email IS NOT NULL)
                      AND course_id IN (SELECT course_id FROM courses)),
        linked AS (SELECT *, (SELECT min(enrollment_id) FROM enrollments e
                              WHERE e.student_id = calls.student_id AND e.course_id = calls.course_id) AS enrollment_id
                   FROM calls)
        SELECT enrollment_id, assessment_type, max_by(score, seq) AS score, max_by(weight, seq) AS weight
        FROM linked GROUP BY enrollment_id, assessment_type
        """,
        "lines",
        "orders_placed",
        "students",
        "courses",
        "enrollments",
    )
    out["ordered_grade_stream"] = with_views(
        """
        , named AS (SELECT o_orderkey, email, course_code, o.student_id, o.course_id FROM orders_placed o
                    JOIN students s ON s.student_id = o.student_id JOIN courses c ON c.course_id = o.course_id
                    WHERE email IS NOT NULL),
        enrolled AS (SELECT DISTINCT email, course_code FROM named
                     WHERE (student_id, course_id) IN (SELECT (student_id, course_id) FROM held_enrollments)
                       OR (o_orderkey % 7 <> 0 AND o_orderkey NOT IN (SELECT enrollment_id FROM held_enrollments))),
        calls AS (SELECT email, course_code, assessment_type AS assessment, score, weight,
                    l_orderkey * 100000000 + l_partkey * 10 + l_linenumber AS seq
                  FROM lines JOIN named ON l_orderkey = o_orderkey WHERE l_partkey % 97 <> 0),
        lead AS (SELECT email, course_code, assessment, max_by(score, seq) AS score, max_by(weight, seq) AS weight
                 FROM calls GROUP BY email, course_code, assessment)
        SELECT lead.*, CASE WHEN (email, course_code) IN (SELECT (email, course_code) FROM enrolled)
                       THEN 'graded' ELSE 'waiting' END AS status FROM lead
        """,
        "lines",
        "orders_placed",
        "students",
        "courses",
        "held_enrollments",
    )
    out["late_references"] = with_views(
        """
        , known_students AS (SELECT * FROM students WHERE email IS NOT NULL),
        known_courses AS (SELECT * FROM courses WHERE course_id % 11 <> 0),
        feed AS (SELECT student_id, concat('P', cast(case when l_linenumber <= 3 then course_id else l_partkey + 50 end as varchar))
                   AS code, assessment_type, score, weight FROM lines JOIN orders_placed ON l_orderkey = o_orderkey),
        named AS (SELECT feed.*, s.student_id AS held, c.course_id FROM feed
                  LEFT JOIN known_students s USING (student_id) LEFT JOIN known_courses c ON course_code = code),
        marks AS (SELECT s.student_id, c.course_id, e.status,
                    (s.student_id, c.course_id) IN (SELECT (student_id, course_id) FROM named
                       WHERE held IS NOT NULL AND course_id IS NOT NULL) AS enrolled, email
                  FROM event_rows e JOIN orders_placed o ON e.enrollment_id = o.o_orderkey
                  JOIN students s USING (student_id) JOIN courses c ON c.course_id = o.course_id
                  WHERE status IN ('Present', 'Absent', 'Late', 'Excused'))
        SELECT student_id, course_id, 'External Transfer' AS semester, assessment_type, score, weight,
          NULL AS status, NULL::BIGINT AS rows
        FROM named WHERE held IS NOT NULL AND course_id IS NOT NULL
        UNION ALL SELECT student_id, course_id, NULL, NULL, NULL, NULL, status, count(*) FROM marks WHERE enrolled GROUP BY ALL
        UNION ALL SELECT NULL, NULL, 'mark_attendance', NULL, NULL, NULL, 'enrollments', count(*) FROM marks
          WHERE NOT enrolled AND email IS NOT NULL HAVING count(*) > 0
        UNION ALL SELECT NULL, NULL, 'load_grades', NULL, NULL, NULL, case when held is null then 'students' else 'courses' end, count(*)
          FROM named WHERE held IS NULL OR course_id IS NULL GROUP BY ALL
        """,
        "lines",
        "orders_placed",
        "students",
        "courses",
        "event_rows",
    )
    out["incremental_reports"] = with_views(
        f"""
        , enrollments AS (SELECT o_orderkey AS enrollment_id, student_id, course_id, semester FROM orders_placed
                          WHERE student_id % 13 <> 0),
        news AS (SELECT l_orderkey AS enrollment_id, assessment_type, score, weight FROM lines WHERE l_linenumber > 4
                 QUALIFY row_number() OVER (PARTITION BY l_orderkey, assessment_type
                   ORDER BY {", ".join(f"{c} DESC" for c in LINE_ORDER)}) = 1),
        olds AS (SELECT l_orderkey AS enrollment_id, assessment_type, score FROM lines WHERE l_linenumber <= 4),
        grades AS (SELECT olds.enrollment_id, case when news.enrollment_id is null then olds.score else news.score end AS score
                   FROM olds LEFT JOIN news USING (enrollment_id, assessment_type)
                   UNION ALL SELECT enrollment_id, score FROM news ANTI JOIN olds USING (enrollment_id, assessment_type))
        SELECT 'performance' AS report, course_code, count(*) AS total_assessments, {_mean()} AS average_score,
          {_TIER} AS performance_category, NULL AS student_id, NULL AS course_id, NULL AS total_classes,
          NULL AS classes_attended, NULL AS semester, NULL AS final_score, NULL AS letter_grade
        FROM grades JOIN enrollments USING (enrollment_id) JOIN courses USING (course_id) GROUP BY course_code
        UNION ALL SELECT 'attendance', NULL, NULL, NULL, NULL, student_id, course_id, total_classes, classes_attended,
          NULL, NULL, NULL FROM ({_stats()})
        UNION ALL SELECT 'transcript', course_code, NULL, NULL, NULL, student_id, NULL, NULL, NULL, semester, final_score,
          letter_grade FROM ({_VIEW})
        """,
        "students",
        "courses",
        "attendance",
        "lines",
        "orders_placed",
    )
    out["published_tables"] = with_views(
        ", twice AS (SELECT * FROM attendance UNION ALL SELECT * FROM attendance)" + _risk("twice"),
        "attendance",
        "enrollments",
        "students",
        "courses",
    )
    out["full_run"] = with_views(
        f"""
        , people AS (SELECT *, row_number() OVER (ORDER BY email) AS id FROM people_feed
                     WHERE {_PEOPLE_KEPT} AND try_cast(dob as date) IS NOT NULL),
        feed AS (SELECT o.student_id, l.assessment_type, l.score, l.weight, p.email, c.course_code
                 FROM lines l JOIN orders_placed o ON l.l_orderkey = o.o_orderkey LEFT JOIN people p ON p.id = o.student_id
                 LEFT JOIN course_offers c ON c.course_code = concat('P', cast(case when l.l_linenumber <= 3 then o.course_id
                   else l.l_partkey + 50 end as varchar))),
        refs AS (SELECT * FROM feed WHERE email IS NOT NULL AND course_code IS NOT NULL),
        counts AS (SELECT 'students' AS "table", count(*) AS "rows" FROM people
                   UNION ALL SELECT 'courses', count(*) FROM course_offers
                   UNION ALL SELECT 'enrollments', count(*) FROM (SELECT DISTINCT email, course_code FROM refs)
                   UNION ALL SELECT 'grades', count(*) FROM refs
                   UNION ALL SELECT 'attendance', cast(0 as bigint)),
        taken AS (SELECT count(*) AS n FROM people),
        kept AS (SELECT count(*) AS n FROM people_feed WHERE {_PEOPLE_KEPT}),
        told AS (SELECT 'people' AS feed, 'extracted' AS metric, count(*) AS n FROM people_feed
                 UNION ALL SELECT 'people', 'kept', n FROM kept
                 UNION ALL SELECT 'people', unnest(['processed', 'inserted']), n FROM taken
                 UNION ALL SELECT 'people', 'skipped', 0
                 UNION ALL SELECT 'catalog', unnest(['extracted', 'kept', 'processed', 'inserted']), count(*) FROM course_offers
                 UNION ALL SELECT 'catalog', 'skipped', 0
                 UNION ALL SELECT 'grades', 'extracted', count(*) FROM feed
                 UNION ALL SELECT 'grades', concat('added_', "table"), "rows" FROM counts
                   WHERE "table" IN ('enrollments', 'grades') AND "rows" > 0
                 UNION ALL SELECT 'grades', case when email is null then 'student_not_found' else 'course_not_found' end, count(*)
                   FROM feed WHERE email IS NULL OR course_code IS NULL GROUP BY ALL)
        SELECT "table", "rows", case "table" when 'students' then "rows" > 100
               when 'courses' then "rows" BETWEEN 20 AND 40 else true end AS passed,
          NULL AS email, NULL AS first_name, NULL AS last_name, NULL AS major, NULL::DATE AS date_of_birth,
          NULL AS course_code, NULL AS course_name, NULL::INT AS credits,
          NULL AS assessment_type, NULL::DECIMAL(5,2) AS score, NULL::DECIMAL(3,2) AS weight, NULL AS feed, NULL AS metric FROM counts
        UNION ALL SELECT NULL, NULL, NULL, email, first_name, last_name, major, try_cast(dob AS date), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
          FROM people
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, course_code, course_name, credits, NULL, NULL, NULL, NULL, NULL
          FROM course_offers
        UNION ALL SELECT NULL, NULL, NULL, email, NULL, NULL, NULL, NULL, course_code, NULL, NULL, assessment_type, score, weight, NULL, NULL
          FROM refs
        UNION ALL SELECT NULL, n, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, feed, metric FROM told
        """,
        "people_feed",
        "lines",
        "orders_placed",
        "course_offers",
    )

    out["row_count_checks"] = with_views(
        """
        , counts AS (SELECT 'students' AS "table", count(*) AS "rows", cast(101 as bigint) AS low,
                            cast(null as bigint) AS high FROM students
                     UNION ALL SELECT 'courses', count(*), 20, 40 FROM courses
                     UNION ALL SELECT 'enrollments', count(*), null, null FROM enrollments
                     UNION ALL SELECT 'grades', count(*), null, null FROM grades
                     UNION ALL SELECT 'attendance', count(*), null, null FROM attendance)
        SELECT *, "rows" >= coalesce(low, "rows") AND "rows" <= coalesce(high, "rows") AS passed FROM counts
        """,
        *_FIVE,
    )
    out["dq_summary"] = with_views(_dq(), "students", "courses", "enrollments", "attendance", "entries", "loose_grades")

    out["calendar_spine"] = with_views(
        """
        , days AS (SELECT enrollment_id, unnest(generate_series(enrollment_date - 45, enrollment_date - 31,
                          interval 1 day)) AS d FROM enrollments)
        SELECT enrollment_id, cast(d as date) AS class_date FROM days WHERE isodow(d) <= 5
        """,
        "enrollments",
    )
    out["sample_courses"] = with_views(_sample(), "students", "courses")
    template = "(VALUES ('Midterm', 0.30), ('Final', 0.50), ('Project', 0.20)) t(assessment_type, weight)"
    out["backfill_children"] = with_views(
        f"""
        SELECT e.enrollment_id, t.assessment_type, cast(t.weight as decimal(3,2)) AS weight
        FROM enrollments e, {template}
        WHERE NOT EXISTS (SELECT 1 FROM grades g WHERE g.enrollment_id = e.enrollment_id)
        """,
        "enrollments",
        "grades",
    )
    out["backfill_attendance"] = with_views(
        f"""
        , days AS (SELECT unnest(generate_series({_EPOCH} - 45, {_EPOCH} - 31, interval 1 day)) AS d)
        SELECT e.enrollment_id, 'Present' AS status, cast(d as date) AS attendance_date
        FROM enrollments e, days
        WHERE isodow(d) <= 5 AND NOT EXISTS (SELECT 1 FROM attendance a WHERE a.enrollment_id = e.enrollment_id)
        """,
        "enrollments",
        "attendance",
    )
    return out


def _draw(*parts: str) -> str:
    text = ", ".join(f"cast({p} as varchar)" for p in (*parts, "7"))
    return f"cast(concat('0x', substr(md5(concat_ws('|', {text})), 1, 15)) as bigint)"


def _sample() -> str:
    at = _draw("w.student_id", "(n - k + step)") + " % (n - k + step + 1)"
    return f"""
    , want AS (SELECT student_id, (SELECT count(*) FROM courses) AS n,
                      least({_draw("student_id")} % 4 + 3, (SELECT count(*) FROM courses)) AS k FROM students),
    draws AS /*recursive*/ (
      SELECT student_id, n, k, cast(0 as bigint) AS step, cast([] as bigint[]) AS taken FROM want
      UNION ALL
      SELECT w.student_id, n, k, step + 1,
             list_append(taken, case when list_contains(taken, {at}) then n - k + step else {at} end)
      FROM draws w WHERE step < k),
    numbered AS (SELECT course_id, row_number() OVER (ORDER BY course_id) - 1 AS pos FROM courses),
    drawn AS (SELECT student_id, unnest(taken) AS pos FROM draws WHERE step = k)
    SELECT d.student_id, c.course_id FROM drawn d JOIN numbered c ON d.pos = c.pos
    """


def _dq() -> str:
    rules = [
        ("assessment_missing", "assessment is null"),
        ("assessment_too_long", "length(rtrim(assessment)) > 50"),
        ("score_bad_number", "try_cast(score as decimal(5,2)) is null"),
        ("score_out_of_range", "not (try_cast(score as decimal(5,2)) between 0 and 100)"),
        ("weight_bad_number", "try_cast(weight as decimal(3,2)) is null"),
        ("entry_date_bad_shape", "not regexp_matches(entry_date, '^\\d{4}-\\d{2}-\\d{2}')"),
        ("entry_date_not_a_date", "try_cast(entry_date as date) is null"),
        ("status_not_allowed", "status not in ('Present', 'Absent', 'Late', 'Excused')"),
        ("credits_not_positive", "credits <= 0"),
    ]
    people = [
        ("first_name_missing", "first_name is null"),
        ("email_missing", "email is null"),
        ("first_name_too_long", "length(rtrim(first_name)) > 50"),
        ("email_too_long", "length(rtrim(email)) > 100"),
    ]
    parts = [
        f"SELECT '{name}' AS rule, '{table}' AS \"table\", count(*) AS checked, count(*) FILTER ({test}) AS failed FROM {table}"
        for table, group in (("entries", rules), ("students", people))
        for name, test in group
    ]
    for table, source, keys in (
        ("students", "students", ["student_id"]),
        ("students", "students", ["email"]),
        ("enrollments", "enrollments", ["student_id", "course_id", "semester"]),
        ("grades", "loose_grades", ["enrollment_id", "assessment_type"]),
    ):
        full = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        cols = ", ".join(keys)
        parts.append(
            f"SELECT 'unique_{'_'.join(keys)}', '{table}', (SELECT count(*) FROM {source}), "
            f"(SELECT count(*) FROM {source} WHERE {full}) - "
            f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {source} WHERE {full}))"
        )
    for child, source, fk, parent in (
        ("enrollments", "enrollments", "student_id", "students"),
        ("enrollments", "enrollments", "course_id", "courses"),
        ("grades", "loose_grades", "enrollment_id", "enrollments"),
        ("attendance", "attendance", "enrollment_id", "enrollments"),
    ):
        parts.append(
            f"SELECT 'orphan_{fk}', '{child}', count(*), "
            f"count(*) FILTER ({fk} IS NOT NULL AND {fk} NOT IN (SELECT {fk} FROM {parent})) FROM {source}"
        )
    parts.append("SELECT 'row_count', 'students', count(*), case when count(*) > 100 then 0 else 1 end FROM students")
    parts.append(
        "SELECT 'row_count', 'courses', count(*), case when count(*) between 20 and 40 then 0 else 1 end FROM courses"
    )
    union = " UNION ALL ".join(parts)
    return f", checks AS ({union}) SELECT *, failed = 0 AS passed FROM checks"
