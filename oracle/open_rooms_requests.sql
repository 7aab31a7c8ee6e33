, request AS (SELECT term, cid, cid % 7 AS extra FROM course),
spare AS (
  SELECT t.term, r.build, r.room, r.capacity FROM (SELECT DISTINCT term FROM request) t, roomcap r
  WHERE r.capacity IS NOT NULL AND NOT EXISTS (FROM meeting m WHERE m.term = t.term AND m.build = r.build AND m.room = r.room)
),
held AS (
  SELECT q.term, q.cid, q.extra, p.peak AS filled, count(*) AS times
  FROM request q JOIN meeting m USING (term, cid) JOIN peak p USING (term, build, room)
  WHERE p.peak + q.extra <= (SELECT max(capacity) FROM spare s WHERE s.term = q.term)
  GROUP BY ALL
),
fullest AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY term, cid ORDER BY filled DESC) = 1),
listed AS (
  SELECT f.term, f.cid, f.extra, s.build, s.room, s.capacity AS cap, f.filled,
         row_number() OVER (PARTITION BY f.term, f.cid ORDER BY s.capacity, s.build, s.room)::INT AS rank
  FROM fullest f JOIN spare s ON s.term = f.term AND s.capacity >= f.filled + f.extra, range(f.times)
)
SELECT term, cid, extra, rank, build, room, cap, filled FROM listed WHERE rank <= 5
