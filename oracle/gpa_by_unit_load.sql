SELECT u AS units, round(coalesce(points / nullif(weight, 0), 0), 6) AS gpa
FROM (SELECT range AS u FROM range(1, 21)) LEFT JOIN (
  SELECT sum_units, CAST(sum(points) AS DOUBLE) AS points,
         CAST(count(*) + coalesce(sum(CASE WHEN mapped THEN units_gained END), 0) AS DOUBLE) AS weight
  FROM (SELECT e.term, sid, sum(units_gained) AS sum_units FROM enroll e, course c
        WHERE e.term = c.term AND e.cid = c.cid GROUP BY e.term, sid) s JOIN graded g USING (term, sid)
  GROUP BY sum_units) ON u = sum_units
