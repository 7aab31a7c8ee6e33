SELECT * FROM sections_in
