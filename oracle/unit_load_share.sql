SELECT u AS units,
       round(sum((SELECT count(*) FROM (SELECT sum(units_gained) AS s FROM enroll e, course c
                                        WHERE e.term = t.term AND c.cid = e.cid AND c.term = t.term
                                          AND (c.subj = 'ABC' OR c.subj = 'DEF')
                                        GROUP BY sid) x WHERE x.s = u)
                 / CAST(n AS DOUBLE))
             / (SELECT count(DISTINCT term) FROM course), 6) AS share
FROM (SELECT range AS u FROM range(1, 21)),
     (SELECT e.term, count(DISTINCT s.sid) AS n FROM student s, enroll e, course c
      WHERE e.cid = c.cid AND e.sid = s.sid AND e.term = c.term GROUP BY e.term) t
GROUP BY u
