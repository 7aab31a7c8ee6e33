SELECT c.crse, coalesce(lo.full_name, '') AS lowest_name, round(coalesce(lo.passrate, 1), 2) AS lowest,
       coalesce(hi.full_name, '') AS highest_name, round(coalesce(hi.passrate, 0), 2) AS highest
FROM (SELECT DISTINCT crse FROM passing) c
LEFT JOIN (SELECT DISTINCT ON (crse) * FROM passing WHERE passrate < 1 ORDER BY crse, passrate, full_name) lo ON lo.crse = c.crse
LEFT JOIN (SELECT DISTINCT ON (crse) * FROM passing WHERE passrate > 0 ORDER BY crse, passrate DESC, full_name) hi ON hi.crse = c.crse
