SELECT target_subj, target_crse, subj, crse, round(share, 6) AS share FROM prereq
