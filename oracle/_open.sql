-- The course's rooms with their fullest moment in the term; the fullest that the largest free room could take decides.
busy AS (SELECT DISTINCT build, room FROM meeting WHERE term = '200101'),
free AS (SELECT build, room, capacity FROM roomcap ANTI JOIN busy USING (build, room) WHERE capacity IS NOT NULL),
held_in AS (
  SELECT p.peak AS seats FROM meeting JOIN peak p USING (term, build, room) WHERE term = '200101' AND cid = 10041
),
needed AS (
  SELECT seats, count(*) AS times FROM held_in
  WHERE seats + 5 <= (SELECT max(capacity) FROM free) GROUP BY seats ORDER BY seats DESC LIMIT 1
),
opened AS (
  SELECT build, room, capacity AS cap, seats AS filled FROM free, needed, range(times) WHERE capacity - 5 >= seats
)
