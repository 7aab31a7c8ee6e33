SELECT CAST(sid AS INTEGER) AS sid, prefname, surname || '-' || (SELECT min(term) FROM enroll e WHERE e.sid = s.sid) AS surname, email
FROM student s WHERE sid IN (SELECT sid FROM enroll)
