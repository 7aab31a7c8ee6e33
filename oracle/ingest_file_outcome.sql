SELECT report.term || '.csv' AS file, one IS NULL AS accepted, one.rule AS rule, one.section AS section, one.term AS term, one.cid::INT AS cid, one.sid AS sid
FROM report LEFT JOIN (
  SELECT i, min({'phase': phase, 'section': section, 'rule': rule, 'term': term, 'cid': cid, 'sid': sid}) AS one FROM breach GROUP BY i) USING (i)
