SELECT term, build, room, "day", st, en, subj, crse FROM clash
