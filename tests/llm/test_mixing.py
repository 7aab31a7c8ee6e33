"""Targets against water filling by rounds, taken words against them."""

import re

import pytest
from pyspark.sql import functions as F

from gradeweave.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    open_ = set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        for s in over or open_:
            out[s] = most * sizes[s] if over else weight[s] * level
        left -= sum(most * sizes[s] for s in over)
        open_ = open_ - over if over else set()
    return out


def check(docs, rows):
    got = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = {}
    for _, t, s in rows:
        sums[s] = sums.get(s, 0) + size(t)
    want = targets(sums)
    assert sorted(((r.doc_id, r.size, r.source, r.source_size) for r in got), key=str) == sorted(((i, size(t), s, sums[s]) for i, t, s in rows), key=str)
    for s in sums:
        mine = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(want[s]) for r in mine)
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= largest / 2 + 1 + len(mine) * 0.001
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
    return got


def test_edge_rows(edge_docs, edge_rows, no_docs):
    check(edge_docs, [(r[0], r[1], r[3]) for r in edge_rows])
    assert mixing.mix(no_docs).collect() == []


def test_copies_and_a_hot_source(spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 7}" if i % 3 else "hot") for i in range(600)]
    rows += [(9999, "the same row " * 5, "s3")] * 300 + [(i, None, "s5") for i in range(20)] + [(5, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = check(docs, rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    kept = mixing.mixed_rows(docs.withColumnRenamed("source", "source"))
    assert kept.columns == docs.columns
    size = lambda t: len((t or "").split())
    taken = {}
    for r in got:
        if r.doc_id != 9999:
            taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + r.taken
    times = {}
    for r in kept.collect():
        if r.doc_id != 9999:
            times[r.doc_id, r.source] = times.get((r.doc_id, r.source), 0) + size(r.text)
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in times.items() if v}
    copies = sum(r.doc_id == 9999 for r in kept.collect())
    assert copies * 15 == sum(r.taken for r in got if r.doc_id == 9999) and copies % 300
    shuffled = docs.orderBy(F.rand())  # in another order whenever it is read
    assert sorted(map(str, mixing.mixed_rows(shuffled).collect())) == sorted(map(str, kept.collect()))
