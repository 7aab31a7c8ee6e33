SELECT full_name, round(CAST(gpa AS DOUBLE), 6) AS gpa FROM by_instructor
