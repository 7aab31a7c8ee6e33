, history AS (
  SELECT sid, list(DISTINCT {'term': term, 'course': subj || ' ' || crse}) AS steps FROM enroll JOIN course USING (term, cid) GROUP BY sid
),
attempt AS (
  SELECT sid, steps, goal, list_max([s.term FOR s IN steps IF s.course = goal]) AS latest
  FROM history, (SELECT DISTINCT subj || ' ' || crse AS goal FROM course) WHERE list_contains([s.course FOR s IN steps], goal)
),
earlier AS (SELECT goal, unnest(list_distinct([s.course FOR s IN steps IF s.term < latest])) AS taken FROM attempt)
SELECT split_part(goal, ' ', 1) AS target_subj, split_part(goal, ' ', 2) AS target_crse, split_part(taken, ' ', 1) AS subj, split_part(taken, ' ', 2) AS crse,
       round(count(*)::DOUBLE / (SELECT count(*) FROM attempt a WHERE a.goal = e.goal), 6) AS share
FROM earlier e GROUP BY goal, taken
