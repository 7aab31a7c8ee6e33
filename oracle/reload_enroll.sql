SELECT sid, term, cid, seat::BIGINT AS seat, units_gained::BIGINT AS units_gained, status, class, major, level, grade FROM loaded_enroll
