SELECT term || '.csv' AS file, kind, count(*) AS records, count(DISTINCT cid) AS sections
FROM (
  SELECT term, cid, unnest(['CID', 'INSTRUCTOR(S)', 'SEAT']) AS kind FROM (SELECT term, cid FROM sections_in UNION ALL SELECT term, 9990 FROM ends)
  UNION ALL SELECT term, cid, 'CID' FROM (SELECT term, cid FROM sections_in UNION ALL SELECT term, 9990 FROM ends)
  UNION ALL SELECT term, cid, 'CID' FROM course WHERE idx%5 = 0
  UNION ALL SELECT term, cid, 'INSTRUCTOR(S)' FROM (SELECT term, cid FROM meetings_in
                                                    UNION ALL SELECT term, unnest([9990, 9990]) FROM ends
                                                    UNION ALL SELECT term, cid FROM course WHERE idx%4 = 0)
  UNION ALL SELECT term, cid, 'SEAT' FROM enroll
  UNION ALL SELECT term, 9990, 'SEAT' FROM ends
  UNION ALL SELECT term, 0, NULL FROM ends
)
GROUP BY ALL
