SELECT full_name, crse, round(CAST(gpa AS DOUBLE), 6) AS gpa FROM by_course
