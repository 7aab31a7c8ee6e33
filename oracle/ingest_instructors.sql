SELECT DISTINCT full_name FROM meetings_in
