SELECT DISTINCT term FROM course
