SELECT sid, prefname, surname || '-' || (SELECT min(term) FROM loaded_enroll e WHERE e.sid = s.sid) AS surname, email
FROM student s WHERE sid IN (SELECT sid FROM loaded_enroll)
UNION ALL
SELECT sid, 'Guest', 'Guest', CASE season WHEN '10' THEN 'shared@example.edu' ELSE 'guest' || sid || '@example.edu' END
FROM guest JOIN taken_file USING (i)
