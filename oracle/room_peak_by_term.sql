SELECT build, room, term, peak FROM peak
