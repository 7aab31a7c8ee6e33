-- Each table with some rows once more, one column of them unknown, too wide or pointing nowhere.
seat_rows AS (
  SELECT sid, term, CAST(10000 + idx*10 + sec AS INTEGER) AS cid, CASE WHEN k%11 = 0 THEN '' ELSE 'RE' END AS status, 'SO' AS class,
         substr(seg, 1, 3) || '1' AS major, 'SO' AS level,
         ['A+','A','A-','B+','B','B-','C+','C','C-','D+','D','D-','F','P','S','NP',''][k%17 + 1] AS grade
  FROM base
),
course_x AS (
  FROM course
  UNION ALL SELECT * REPLACE (NULL AS term) FROM course WHERE idx = 1
  UNION ALL SELECT * REPLACE (NULL AS cid) FROM course WHERE idx = 1
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS term) FROM course WHERE idx = 1
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS subj) FROM course WHERE idx = 1
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS crse) FROM course WHERE idx = 1
  UNION ALL FROM course WHERE idx = 1
),
instructor_x AS (
  FROM instructor
  UNION ALL SELECT * REPLACE (NULL AS full_name) FROM instructor WHERE full_name LIKE '%7'
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS full_name) FROM instructor WHERE full_name LIKE '%7'
  UNION ALL FROM instructor WHERE full_name LIKE '%7'
),
meeting_x AS (
  FROM meeting
  UNION ALL SELECT * REPLACE (NULL AS term) FROM meeting WHERE pos = 2
  UNION ALL SELECT * REPLACE (NULL AS cid) FROM meeting WHERE pos = 2
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS build) FROM meeting WHERE pos = 2
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS typ) FROM meeting WHERE pos = 2
  UNION ALL SELECT * REPLACE ('Nobody' AS full_name) FROM meeting WHERE pos = 2
  UNION ALL SELECT * REPLACE (-1 AS cid) FROM meeting WHERE pos = 2
  UNION ALL FROM meeting WHERE pos = 2
),
daytime_x AS (
  FROM daytime
  UNION ALL SELECT * REPLACE (NULL AS term) FROM daytime WHERE "day" = 'F'
  UNION ALL SELECT * REPLACE (NULL AS cid) FROM daytime WHERE "day" = 'F'
  UNION ALL SELECT * REPLACE (NULL AS pos) FROM daytime WHERE "day" = 'F'
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS "day") FROM daytime WHERE "day" = 'F'
  UNION ALL SELECT * REPLACE (9 AS pos) FROM daytime WHERE "day" = 'F'
  UNION ALL FROM daytime WHERE "day" = 'F'
),
student_x AS (
  FROM student
  UNION ALL SELECT * REPLACE (NULL AS sid) FROM student WHERE sid % 7 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS prefname) FROM student WHERE sid % 7 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS surname) FROM student WHERE sid % 7 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS email) FROM student WHERE sid % 7 = 0
  UNION ALL FROM student WHERE sid % 7 = 0
),
enroll_x AS (
  FROM seat_rows
  UNION ALL SELECT * REPLACE (NULL AS sid) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (NULL AS term) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (NULL AS cid) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS term) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS status) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS class) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS major) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS level) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS grade) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (-1 AS sid) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL SELECT * REPLACE (-1 AS cid) FROM seat_rows WHERE sid % 5 = 0
  UNION ALL FROM seat_rows WHERE sid % 5 = 0
),
roomcap_x AS (
  FROM roomcap
  UNION ALL SELECT * REPLACE (NULL AS build) FROM roomcap WHERE room = 103
  UNION ALL SELECT * REPLACE (NULL AS room) FROM roomcap WHERE room = 103
  UNION ALL SELECT * REPLACE (repeat('x', 400) AS build) FROM roomcap WHERE room = 103
  UNION ALL FROM roomcap WHERE room = 103
)
