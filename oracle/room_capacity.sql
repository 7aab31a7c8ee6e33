SELECT build, room, capacity FROM roomcap
