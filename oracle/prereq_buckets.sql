SELECT target_subj, target_crse,
       CASE WHEN share > 0.95 THEN '>95%' WHEN share > 0.90 THEN '>90%' WHEN share > 0.85 THEN '>85%'
            WHEN share > 0.80 THEN '>80%' WHEN share > 0.75 THEN '>75%' END AS bucket,
       subj, crse, round(share, 3) AS share
FROM prereq WHERE share > 0.75
