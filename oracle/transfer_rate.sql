SELECT round(CAST(coalesce((SELECT sum(n) FROM moved), 0) AS DOUBLE) / (SELECT count(*) FROM student), 6) AS rate
