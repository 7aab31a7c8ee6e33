SELECT CAST(sid AS INTEGER) AS sid, term, cid, CAST(seat AS INTEGER) AS seat, CAST(units_gained AS INTEGER) AS units_gained,
       status, class, major, level, grade
FROM enroll
