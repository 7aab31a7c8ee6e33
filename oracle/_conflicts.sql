-- A booking is in conflict if a course of a higher number is taught by someone else in its place while it lasts.
booking AS (
  SELECT DISTINCT term || ' ' || build || ' ' || room || ' ' || "day" AS place, term, build, room, "day", daytime.st, daytime.en, subj, crse, full_name
  FROM daytime JOIN meeting USING (term, cid, pos) JOIN course USING (term, cid)
  WHERE right(term, 1) = '6' AND daytime.st + daytime.en IS NOT NULL
),
rival AS (SELECT place AS its_place, st AS begins, en AS ends, subj AS other_subj, crse AS other_crse, full_name AS teacher FROM booking),
clash AS (
  SELECT DISTINCT term, build, room, "day", st, en, subj, crse FROM booking
  WHERE EXISTS (FROM rival WHERE its_place = place AND least(ends, en) > greatest(begins, st) AND other_crse > crse AND teacher <> full_name)
),
shown AS (
  SELECT st, en, min({'term': term, 'subj': subj, 'crse': crse}) AS one FROM clash GROUP BY st, en
),
conflicts AS (
  SELECT one.subj AS subj1, one.crse AS crse1, two.subj AS subj2, two.crse AS crse2, one.term AS term, st, en
  FROM (SELECT s.st, s.en, s.one,
               (SELECT min({'subj': other_subj, 'crse': other_crse}) FROM booking b JOIN rival r ON r.its_place = b.place
                WHERE b.st = s.st AND b.en = s.en AND b.term = s.one.term AND b.subj = s.one.subj AND b.crse = s.one.crse
                  AND least(r.ends, b.en) > greatest(r.begins, b.st) AND r.other_crse > b.crse AND r.teacher <> b.full_name) AS two
        FROM shown s)
)
