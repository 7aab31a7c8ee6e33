SELECT coalesce(lo.full_name, '') AS lowest_name, round(coalesce(lo.gpa, 4), 2) AS lowest,
       coalesce(hi.full_name, '') AS highest_name, round(coalesce(hi.gpa, 0), 2) AS highest
FROM (SELECT 1) one
LEFT JOIN (SELECT * FROM by_instructor WHERE gpa >= 0.01 AND gpa < 4 ORDER BY gpa, full_name LIMIT 1) lo ON true
LEFT JOIN (SELECT * FROM by_instructor WHERE gpa >= 0.01 AND gpa > 0 ORDER BY gpa DESC, full_name LIMIT 1) hi ON true
