-- Students who leave a major: they have it in some term and one of the ABC majors in a later term.
last_inside AS (SELECT sid, max(term) AS term FROM enroll WHERE starts_with(major, 'ABC') GROUP BY sid),
outside AS (SELECT DISTINCT sid, major, term FROM enroll WHERE major IS NOT NULL AND NOT starts_with(major, 'ABC')),
moved AS (
  SELECT major, count(*) AS n
  FROM (SELECT DISTINCT sid, major FROM outside o
        WHERE EXISTS (FROM last_inside l WHERE l.sid = o.sid AND o.term < l.term))
  GROUP BY major
)
