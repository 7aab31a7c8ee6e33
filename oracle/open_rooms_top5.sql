SELECT build, room, cap, filled FROM opened ORDER BY cap, build, room LIMIT 5
