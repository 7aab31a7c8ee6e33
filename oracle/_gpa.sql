-- Fixed values: points of a grade, and the weight of a row without one in a GPA (1e-8).
scale AS (
  SELECT unnest(['A+','A','A-','B+','B','B-','C+','C','C-','D+','D','D-','F']) AS grade,
         unnest([4.0, 4.0, 3.7, 3.3, 3.0, 2.7, 2.3, 2.0, 1.7, 1.3, 1.0, 0.7, 0.0]) AS worth
),
graded AS (
  SELECT e.*, coalesce(worth, 0) * units_gained AS points, worth IS NOT NULL AS mapped,
         coalesce(left(grade, 1) IN ('A', 'B', 'C', 'D') OR grade = 'F', false) AS letter
  FROM enroll e LEFT JOIN scale USING (grade)
),
taught AS (SELECT g.*, subj, crse, full_name FROM graded g JOIN course USING (term, cid) JOIN meeting USING (term, cid)),
by_instructor AS (
  SELECT full_name, sum(points) / (coalesce(sum(units_gained) FILTER (mapped), 0) + 1e-8 * count(*) FILTER (NOT mapped)) AS gpa
  FROM taught GROUP BY full_name
),
by_major AS (
  SELECT major, sum(points) / (coalesce(sum(units_gained) FILTER (mapped), 0) + 1e-8 * count(*) FILTER (NOT mapped)) AS gpa
  FROM graded JOIN course USING (term, cid) WHERE subj = 'ABC' GROUP BY major
),
per_course AS (
  SELECT full_name, crse,
         count(*) FILTER (letter) AS lettered, sum(points) FILTER (letter) AS points, sum(units_gained) FILTER (letter AND mapped) AS units,
         count(grade) FILTER (NOT letter) AS others, count(*) FILTER (grade IN ('P', 'S')) AS passed
  FROM taught WHERE subj = 'ABC' AND crse[1] = '1' GROUP BY ALL
),
by_course AS (SELECT full_name, crse, points / nullif(units, 0) AS gpa FROM per_course WHERE lettered > 0),
passing AS (SELECT full_name, crse, passed / others::DOUBLE AS passrate FROM per_course WHERE passed > 0)
