SELECT major, round(CAST(gpa AS DOUBLE), 6) AS gpa FROM by_major
