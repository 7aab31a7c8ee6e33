SELECT b.term, b.build, b.room, b."day", b.st AS st1, b.en AS en1, begins AS st2, ends AS en2, count(*) AS links,
       min({'subj': subj, 'crse': crse, 'subj2': other_subj, 'crse2': other_crse}).subj AS subj1,
       min({'subj': subj, 'crse': crse, 'subj2': other_subj, 'crse2': other_crse}).crse AS crse1,
       min({'subj': subj, 'crse': crse, 'subj2': other_subj, 'crse2': other_crse}).subj2 AS subj2,
       min({'subj': subj, 'crse': crse, 'subj2': other_subj, 'crse2': other_crse}).crse2 AS crse2
FROM booking b JOIN rival ON its_place = place AND least(ends, en) > greatest(begins, st) AND other_crse > crse AND teacher <> full_name
GROUP BY b.term, b.build, b.room, b."day", b.st, b.en, begins, ends
