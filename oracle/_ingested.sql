ends AS (SELECT DISTINCT term, 10990 AS cid FROM course),
sections_in AS (
  SELECT term, cid, min_units, max_units, sec, subj, crse FROM course
  UNION ALL SELECT term, cid, NULL, NULL, 1, 'GHI', '999' FROM ends
),
meetings_in AS (
  SELECT term, cid, full_name, typ, build, room FROM meeting
  UNION ALL SELECT term, cid, 'Nobody', 'Lecture', 'HAL', 999 FROM ends
  UNION ALL SELECT term, cid, '', 'Lab', '', NULL FROM ends
)
