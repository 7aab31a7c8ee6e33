SELECT DISTINCT build, room FROM meetings_in WHERE build <> '' AND room IS NOT NULL
