SELECT term, cid, "day", st, en FROM daytime
UNION ALL SELECT term, cid, unnest(['M', 'W', 'F']), NULL, NULL FROM ends
