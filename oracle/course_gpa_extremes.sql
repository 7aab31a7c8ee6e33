SELECT c.crse, coalesce(lo.full_name, '') AS lowest_name, round(coalesce(lo.gpa, 4), 2) AS lowest,
       coalesce(hi.full_name, '') AS highest_name, round(coalesce(hi.gpa, 0), 2) AS highest
FROM (SELECT DISTINCT crse FROM by_course) c
LEFT JOIN (SELECT DISTINCT ON (crse) * FROM by_course WHERE gpa < 4 ORDER BY crse, gpa, full_name) lo ON lo.crse = c.crse
LEFT JOIN (SELECT DISTINCT ON (crse) * FROM by_course WHERE gpa > 0 ORDER BY crse, gpa DESC, full_name) hi ON hi.crse = c.crse
