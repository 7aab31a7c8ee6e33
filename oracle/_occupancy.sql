sat AS (
  SELECT m.build, m.room, m.term, m.cid, m.pos, e.seat
  FROM enroll e, course c, meeting m
  WHERE e.term = c.term AND e.cid = c.cid AND m.term = c.term AND m.cid = c.cid
    AND e.term NOT IN (SELECT term FROM conflicts)
),
peak AS (
  SELECT build, room, term, max(n) AS peak
  FROM (
    SELECT s.build, s.room, s.term, count(seat) AS n
    FROM sat s, daytime d
    WHERE d.term = s.term AND d.cid = s.cid AND d.pos = s.pos
    GROUP BY s.build, s.room, s.term, d."day", d.st, d.en
    UNION
    SELECT build, room, term, count(seat) AS n FROM sat GROUP BY build, room, term, cid, pos
  )
  GROUP BY build, room, term
),
roomcap AS (
  SELECT r.build, r.room, (SELECT max(peak) FROM peak p WHERE p.build = r.build AND p.room = r.room) AS capacity
  FROM (SELECT DISTINCT build, room FROM meeting WHERE build <> '' AND room IS NOT NULL) r
)
