"""Counts against a plain version, monotonic verdicts, quality on held-out labels."""

import re
from collections import Counter

import numpy as np
import pytest

from gradeweave.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def check(got, rows):
    want = []
    for i, t in rows:
        c = plain(t)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert not any(r.kept and r.base_failed for r in got)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 1), (9, 0), (1, 1)], "doc_id long, quality int")
    rows = [r[:2] for r in edge_rows]
    check(rules.quality_rules(edge_docs, labels).collect(), rows)
    check(rules.quality_rules(edge_docs, labels.limit(0)).collect(), rows)
    assert rules.quality_rules(no_docs, labels).collect() == []


def test_counts_and_verdicts_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    check(rules.quality_rules(docs, labels).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    # learned from one half, judged on the other
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = rules.judged(docs, rules.train(docs, labels.where("doc_id % 2 = 0"))).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    assert np.mean(good) > 0.97
    assert np.mean([r.kept for r in got if r.quality == 0]) < 0.1


@pytest.mark.parametrize("direction", [1, -1, 0])
def test_trees_keep_their_directions(direction):
    rng = np.random.default_rng(2)
    x = rng.random((2000, 2))
    y = (np.sin(9 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.3, 2000) > 0.7).astype(float)
    trees = rules.fit(x, y, [direction, 0])
    for other in (0.1, 0.5, 0.9):
        line = trees.scores(np.column_stack([np.linspace(0, 1, 200), np.full(200, other)]))
        if direction:
            assert (np.diff(line) * direction >= -1e-12).all()
    assert ((trees.scores(x) > 0.5) == y).mean() > (0.8 if direction == 0 else 0.6)
