-- Gradebook relations derived from lineitem, orders and customer.
base AS (
  SELECT o_custkey AS sid, l_orderkey*7 + l_partkey*3 + l_linenumber AS k, c_mktsegment AS seg,
         year(o_orderdate) AS yr,
         CAST(CASE WHEN l_partkey%40 < 8 THEN 0 WHEN l_partkey%40 < 14 THEN 1 WHEN l_partkey%40 < 19 THEN 2
                   WHEN l_partkey%40 < 23 THEN 3 WHEN l_partkey%40 < 26 THEN 4 ELSE 5 + l_partkey%13 END AS INTEGER) AS idx,
         CAST(l_suppkey%2 + 1 AS INTEGER) AS sec,
         CAST(year(o_orderdate)*100 + CASE WHEN month(o_orderdate) <= 3 THEN 1 WHEN month(o_orderdate) <= 6 THEN 3
                   WHEN month(o_orderdate) <= 8 THEN 6 ELSE 10 END AS VARCHAR) AS term
  FROM lineitem, orders, customer
  WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey
),
course AS (
  SELECT DISTINCT term, CAST(10000 + idx*10 + sec AS INTEGER) AS cid, idx, sec, yr,
         CASE WHEN idx IN (0,1,2,3,4,5,10,11,12) THEN 'ABC' WHEN idx IN (6,7,13,14) THEN 'DEF' ELSE 'GHI' END AS subj,
         CASE idx WHEN 0 THEN '203' WHEN 1 THEN '210' WHEN 2 THEN '222' ELSE CAST(100 + idx AS VARCHAR) END AS crse,
         CASE WHEN idx%2 = 0 THEN 1 END AS min_units, CASE WHEN idx%2 = 0 THEN 5 END AS max_units
  FROM base
),
seated AS (
  SELECT sid, term, CAST(10000 + idx*10 + sec AS INTEGER) AS cid, min(yr) AS yr, min(seg) AS seg, min(k) AS k
  FROM base GROUP BY ALL
),
enroll AS (
  SELECT sid, term, cid, row_number() OVER (PARTITION BY term, cid ORDER BY sid) AS seat,
         CASE WHEN k%29 <> 0 THEN 1 + k%5 END AS units_gained,
         CASE WHEN k%11 = 0 THEN '' ELSE 'RE' END AS status, 'SO' AS class,
         CASE WHEN sid%5 = 0 AND yr >= 1998 THEN 'ABC' || CAST(sid%3 AS VARCHAR) ELSE substr(seg, 1, 3) || '1' END AS major,
         'SO' AS level,
         ['A+','A','A-','B+','B','B-','C+','C','C-','D+','D','D-','F','P','S','NP',''][k%17 + 1] AS grade
  FROM seated
),
meeting AS (
  SELECT term, cid, pos, 'Supplier#' || lpad(CAST((idx*7 + yr + sec)%10 AS VARCHAR), 9, '0') AS full_name,
         CASE pos WHEN 1 THEN 'Lecture' ELSE 'Lab' END AS typ,
         CASE idx%3 WHEN 0 THEN 'HAL' WHEN 1 THEN 'OLS' ELSE 'WEL' END AS build,
         CAST(100 + (idx*2 + yr)%12 AS INTEGER) AS room,
         CASE WHEN pos = 2 THEN 'F' WHEN idx%2 = 0 THEN 'MWF' ELSE 'TR' END AS days,
         CASE pos WHEN 1 THEN CAST(60*(480 + 60*((idx + yr)%6) + 10*(yr%3)) + 30*(idx%2) AS INTEGER) END AS st,
         CASE pos WHEN 1 THEN CAST(60*(480 + 60*((idx + yr)%6) + 10*(yr%3) + 50 + 40*sec) + 30*(idx%2) AS INTEGER) END AS en
  FROM course, (SELECT unnest([1, 2]) AS pos)
  WHERE pos = 1 OR idx%4 = 0
),
daytime AS (
  SELECT term, cid, pos, unnest(string_split(days, '')) AS "day", st, en FROM meeting
),
student AS (
  SELECT c_custkey AS sid, c_mktsegment AS prefname, c_name AS surname, lower(c_name) || '@example.edu' AS email
  FROM customer
),
instructor AS (SELECT DISTINCT full_name FROM meeting)
