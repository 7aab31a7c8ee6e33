SELECT build, room, capacity FROM roomcap
UNION ALL SELECT 'HAL', 999, NULL
