SELECT build, room, cap, filled FROM opened
