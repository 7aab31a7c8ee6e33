SELECT major, round(share, 6) AS share
FROM (SELECT major, n / CAST((SELECT count(DISTINCT sid) FROM enroll e WHERE e.major = moved.major) AS DOUBLE) AS share FROM moved)
ORDER BY share DESC, major LIMIT 5
