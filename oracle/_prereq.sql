-- One list of (term, course) per student; who took a course before a target is read off the lists.
history AS (
  SELECT sid, list(DISTINCT {'term': term, 'course': subj || ' ' || crse}) AS steps
  FROM enroll JOIN course USING (term, cid) GROUP BY sid
),
target AS (SELECT unnest(['203', '210', '222']) AS number),
attempt AS (
  SELECT sid, steps, number, list_max([s.term FOR s IN steps IF s.course = 'ABC ' || number]) AS latest
  FROM history, target
),
earlier AS (
  SELECT number, unnest(list_distinct([s.course FOR s IN steps IF s.term < latest])) AS taken
  FROM attempt WHERE latest IS NOT NULL
),
takers AS (SELECT number, count(*) AS students FROM attempt WHERE latest IS NOT NULL GROUP BY number),
prereq AS (
  SELECT 'ABC' AS target_subj, number AS target_crse, split_part(taken, ' ', 1) AS subj, split_part(taken, ' ', 2) AS crse,
         count(*)::DOUBLE / any_value(students) AS share
  FROM earlier JOIN takers USING (number) GROUP BY number, taken
)
