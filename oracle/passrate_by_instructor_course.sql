SELECT full_name, crse, round(passrate, 6) AS passrate FROM passing
