-- One file per term, entered one after the other: the list of files taken so far decides on the next one.
report AS (SELECT term, row_number() OVER (ORDER BY term)::INT AS i, term[1:4] AS year, term[5:6] AS season FROM (SELECT DISTINCT term FROM course)),
guest AS (
  SELECT r.i, coalesce(n.term, r.term) AS term,
         CASE r.season WHEN '06' THEN 10982 WHEN '10' THEN 10981 ELSE (SELECT min(cid) FROM course c WHERE c.term = n.term) END AS cid,
         1 + (SELECT count(*) FROM course c WHERE c.term = r.term) + 1 AS section,
         CASE r.season WHEN '01' THEN 91000000 WHEN '03' THEN 92000000 WHEN '06' THEN 93000000 ELSE 90000000 END + r.year::INT AS sid, r.season
  FROM report r LEFT JOIN report n ON n.term = r.year || CASE r.season WHEN '01' THEN '03' WHEN '03' THEN '06' END
  WHERE n.term IS NOT NULL OR r.season = '10' OR (r.season = '06' AND r.year::INT % 2 = 0)
),
brought AS (
  SELECT i, term, cid, 1 + row_number() OVER (PARTITION BY i ORDER BY cid) AS section FROM course JOIN report USING (term)
  UNION ALL SELECT i, term, cid, section FROM guest
),
rival_file AS (
  SELECT b.i, list(DISTINCT a.i) AS rivals
  FROM (SELECT i, term || ' ' || cid AS claim FROM brought UNION ALL SELECT i, 'shared mail' FROM guest WHERE season = '10') a
  JOIN (SELECT i, term || ' ' || cid AS claim FROM brought UNION ALL SELECT i, 'shared mail' FROM guest WHERE season = '10') b USING (claim)
  WHERE a.i < b.i GROUP BY b.i
),
walk AS (
  SELECT 0 AS i, []::INT[] AS taken
  UNION ALL
  SELECT r.i, CASE WHEN EXISTS (SELECT 1 FROM guest g WHERE g.i = r.i AND g.season = '06') OR list_has_any(coalesce(rivals, []), taken)
                   THEN taken ELSE list_append(taken, r.i) END
  FROM walk JOIN report r ON r.i = walk.i + 1 LEFT JOIN rival_file f ON f.i = r.i
),
taken_file AS (SELECT i, term AS file_term FROM report WHERE list_contains((SELECT taken FROM walk ORDER BY i DESC LIMIT 1), i)),
breach AS (
  SELECT b.i, 0 AS phase, b.section, 'duplicate term, cid' AS rule, b.term, b.cid, NULL::BIGINT AS sid
  FROM brought b JOIN brought a ON a.term = b.term AND a.cid = b.cid AND a.i < b.i JOIN taken_file t ON t.i = a.i
  UNION ALL
  SELECT i, 1, section, CASE season WHEN '06' THEN 'duplicate sid, term, cid' ELSE 'orphan sid in student' END, term, cid, sid
  FROM guest WHERE season IN ('06', '10') AND i NOT IN (SELECT i FROM taken_file)
),
loaded_enroll AS (
  SELECT e.* FROM enroll e JOIN taken_file ON term = file_term
  UNION ALL
  SELECT sid, term, cid, 1, 4, 'RE', 'SO', 'GST1', 'SO', 'P' FROM guest JOIN taken_file USING (i)
)
