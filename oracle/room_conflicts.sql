SELECT subj1, crse1, subj2, crse2, term, st, en FROM conflicts
