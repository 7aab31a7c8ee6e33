SELECT 'course' AS "table", 'missing term' AS rule, count(*) FILTER (term IS NULL) AS violations FROM course_x
UNION ALL SELECT 'course' AS "table", 'missing cid' AS rule, count(*) FILTER (cid IS NULL) AS violations FROM course_x
UNION ALL SELECT 'course', 'too_wide term', count(*) FILTER (length(term) > 40) FROM course_x
UNION ALL SELECT 'course', 'too_wide subj', count(*) FILTER (length(subj) > 3) FROM course_x
UNION ALL SELECT 'course', 'too_wide crse', count(*) FILTER (length(crse) > 10) FROM course_x
UNION ALL SELECT 'course', 'duplicate term, cid', count(*) - count(DISTINCT (term, cid)) FROM course_x WHERE term IS NOT NULL AND cid IS NOT NULL
UNION ALL SELECT 'instructor' AS "table", 'missing full_name' AS rule, count(*) FILTER (full_name IS NULL) AS violations FROM instructor_x
UNION ALL SELECT 'instructor', 'too_wide full_name', count(*) FILTER (length(full_name) > 100) FROM instructor_x
UNION ALL SELECT 'instructor', 'duplicate full_name', count(*) - count(DISTINCT (full_name)) FROM instructor_x WHERE full_name IS NOT NULL
UNION ALL SELECT 'meeting' AS "table", 'missing term' AS rule, count(*) FILTER (term IS NULL) AS violations FROM meeting_x
UNION ALL SELECT 'meeting' AS "table", 'missing cid' AS rule, count(*) FILTER (cid IS NULL) AS violations FROM meeting_x
UNION ALL SELECT 'meeting', 'too_wide build', count(*) FILTER (length(build) > 3) FROM meeting_x
UNION ALL SELECT 'meeting', 'too_wide typ', count(*) FILTER (length(typ) > 50) FROM meeting_x
UNION ALL SELECT 'meeting', 'duplicate term, cid, pos', count(*) - count(DISTINCT (term, cid, pos)) FROM meeting_x WHERE term IS NOT NULL AND cid IS NOT NULL AND pos IS NOT NULL
UNION ALL SELECT 'daytime' AS "table", 'missing term' AS rule, count(*) FILTER (term IS NULL) AS violations FROM daytime_x
UNION ALL SELECT 'daytime' AS "table", 'missing cid' AS rule, count(*) FILTER (cid IS NULL) AS violations FROM daytime_x
UNION ALL SELECT 'daytime' AS "table", 'missing pos' AS rule, count(*) FILTER (pos IS NULL) AS violations FROM daytime_x
UNION ALL SELECT 'daytime', 'too_wide day', count(*) FILTER (length("day") > 7) FROM daytime_x
UNION ALL SELECT 'student' AS "table", 'missing sid' AS rule, count(*) FILTER (sid IS NULL) AS violations FROM student_x
UNION ALL SELECT 'student', 'too_wide prefname', count(*) FILTER (length(prefname) > 50) FROM student_x
UNION ALL SELECT 'student', 'too_wide surname', count(*) FILTER (length(surname) > 50) FROM student_x
UNION ALL SELECT 'student', 'too_wide email', count(*) FILTER (length(email) > 320) FROM student_x
UNION ALL SELECT 'student', 'duplicate sid', count(*) - count(DISTINCT (sid)) FROM student_x WHERE sid IS NOT NULL
UNION ALL SELECT 'student', 'duplicate email', count(*) - count(DISTINCT (email)) FROM student_x WHERE email IS NOT NULL
UNION ALL SELECT 'enroll' AS "table", 'missing sid' AS rule, count(*) FILTER (sid IS NULL) AS violations FROM enroll_x
UNION ALL SELECT 'enroll' AS "table", 'missing term' AS rule, count(*) FILTER (term IS NULL) AS violations FROM enroll_x
UNION ALL SELECT 'enroll' AS "table", 'missing cid' AS rule, count(*) FILTER (cid IS NULL) AS violations FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide term', count(*) FILTER (length(term) > 40) FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide status', count(*) FILTER (length(status) > 10) FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide class', count(*) FILTER (length(class) > 10) FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide major', count(*) FILTER (length(major) > 4) FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide level', count(*) FILTER (length(level) > 10) FROM enroll_x
UNION ALL SELECT 'enroll', 'too_wide grade', count(*) FILTER (length(grade) > 10) FROM enroll_x
UNION ALL SELECT 'enroll', 'duplicate sid, term, cid', count(*) - count(DISTINCT (sid, term, cid)) FROM enroll_x WHERE sid IS NOT NULL AND term IS NOT NULL AND cid IS NOT NULL
UNION ALL SELECT 'roomcap' AS "table", 'missing build' AS rule, count(*) FILTER (build IS NULL) AS violations FROM roomcap_x
UNION ALL SELECT 'roomcap' AS "table", 'missing room' AS rule, count(*) FILTER (room IS NULL) AS violations FROM roomcap_x
UNION ALL SELECT 'roomcap', 'too_wide build', count(*) FILTER (length(build) > 3) FROM roomcap_x
UNION ALL SELECT 'roomcap', 'duplicate build, room', count(*) - count(DISTINCT (build, room)) FROM roomcap_x WHERE build IS NOT NULL AND room IS NOT NULL
UNION ALL SELECT 'meeting', 'orphan full_name in instructor', count(*) FROM meeting_x WHERE full_name IS NOT NULL AND NOT EXISTS (FROM instructor_x o WHERE o.full_name = meeting_x.full_name)
UNION ALL SELECT 'meeting', 'orphan term, cid in course', count(*) FROM meeting_x WHERE term IS NOT NULL AND cid IS NOT NULL AND NOT EXISTS (FROM course_x o WHERE o.term = meeting_x.term AND o.cid = meeting_x.cid)
UNION ALL SELECT 'daytime', 'orphan term, cid, pos in meeting', count(*) FROM daytime_x WHERE term IS NOT NULL AND cid IS NOT NULL AND pos IS NOT NULL AND NOT EXISTS (FROM meeting_x o WHERE o.term = daytime_x.term AND o.cid = daytime_x.cid AND o.pos = daytime_x.pos)
UNION ALL SELECT 'enroll', 'orphan sid in student', count(*) FROM enroll_x WHERE sid IS NOT NULL AND NOT EXISTS (FROM student_x o WHERE o.sid = enroll_x.sid)
UNION ALL SELECT 'enroll', 'orphan term, cid in course', count(*) FROM enroll_x WHERE term IS NOT NULL AND cid IS NOT NULL AND NOT EXISTS (FROM course_x o WHERE o.term = enroll_x.term AND o.cid = enroll_x.cid)
