"""Hosts, paths and rules against a plain reading, models against dictionaries, held-out verdicts."""

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from gradeweave.llm import urls
from gradeweave.llm.textnum import utf8

ODD = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/", "http://example.com/en",
    "http://a.www.example.com/en/?q", "http://wwwexample.com/en/x", "x?u=://b.example.com/en/#://c.net/es/", "http://a.net/es/b?c#d", "http://net/fr/",
    "http://anet/fr/", "ftp://ÄB.NET/fr/é", "http://a.example.net?/fr/", "http://a.example.net#/fr/", "://net/es/\nx", "http://a.b.com/x\ny?z", "http://x.org/" + "long" * 5000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def ruled(host, path):
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def check(got, rows):
    want = []
    for i, u in rows:
        want.append((i, *parts(u), *ruled(*parts(u))))
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got), key=str) == sorted(want, key=str)
    assert all(r.verdict in ("allow", "block") and (r.rule is None) == (r.score is not None) for r in got)


def test_odd_urls(spark):
    rows = list(enumerate(ODD)) + [(3, ODD[6]), (3, ODD[6]), (None, ODD[7]), (None, None)]
    table = spark.createDataFrame([(*r, "html", "host", 1) for r in rows], "page_id long, url string, html string, verdict string, host int").repartition(3)
    got = urls.url_filter(table).collect()
    check(got, rows)
    assert {r.verdict for r in got if r.page_id == 1} == {"allow"}
    assert urls.url_filter(table.limit(0)).collect() == []
    alone = urls.url_filter(table.where("url = '' or url like '%.org%'")).collect()
    assert [r.verdict for r in alone] == ["allow"] * 2  # nothing to learn from


def plain_log_chances(examples, url):
    """Every byte's chance, by recursion over counts in dictionaries."""
    after = defaultdict(lambda: defaultdict(int))
    for e in examples:
        for i in range(len(e)):
            for k in range(min(i, urls.ORDER) + 1):
                after[e[i - k : i]][e[i]] += 1

    def chance(context, symbol):
        shorter = chance(context[1:], symbol) if context else 1 / 256
        seen = after.get(context)
        if not seen or (len(context) > urls.SURE_ORDER and sum(seen.values()) < 2):
            return shorter
        return (seen.get(symbol, 0) + len(seen) * shorter) / (sum(seen.values()) + len(seen))

    return [math.log(chance(url[max(0, i - urls.ORDER) : i], url[i])) for i in range(len(url))]


def test_models_against_dictionaries():
    examples = ["http://a.example.com/en/1", "http://a.example.com/en/22", "b", "", "https://é.example.org/de/77"]
    tried = ["http://a.example.com/fr/1", "", "zzz", "b", "https://é.example.org"]
    model = urls.learned(pa.array(examples))
    data, offsets = utf8(pa.array(tried))
    got = model.log_chances(data, offsets)
    want = [p for t in tried for p in plain_log_chances([e.encode() for e in examples], t.encode())]
    assert np.allclose(got, want, rtol=1e-12)
    whole = sum(math.exp(model.log_chances(*utf8(pa.array([b"http://a" + bytes([s])])))[-1]) for s in range(256))
    assert abs(whole - 1) < 1e-9


def test_scores_of_a_table_and_held_out_examples(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.url_filter(pages).collect()
    check(got, [(r.page_id, r.url) for r in pages.select("page_id", "url").collect()])
    judged = urls.judged_by_rules(pages).collect()
    model = urls.trained(spark.createDataFrame([r for r in judged if r.page_id % 2], "page_id long, url string, host string, path string, rule string, ruled string"))
    other = [r for r in judged if r.page_id % 2 == 0 and r.ruled]
    chances = model.chances(model.scores(*utf8(pa.array([r.url for r in other]))))
    assert np.mean((chances >= 0.5) == np.array([r.ruled == "allow" for r in other])) > 0.95


def test_a_falling_curve_is_not_used():
    assert urls.calibrated(np.array([-1.0, -2.0]), np.array([1.0, 2.0])) == (1.0, 0.0)
    slope, offset = urls.calibrated(np.array([1.0, 2.0, 0.5]), np.array([-1.0, -0.1]))
    assert slope > 0 and -0.1 < -offset / slope < 0.5
