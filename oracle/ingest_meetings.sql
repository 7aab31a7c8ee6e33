SELECT * FROM meetings_in
