SELECT DISTINCT build, room, cap, filled FROM opened
