"""Benchmark windows against a plain search, and the index against all places."""

import hashlib
import re

import numpy as np
import pytest

from gradeweave.llm import fmindex, leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for a in range(len(w)):
            for b in range(a + 1, min(a + 10, len(w)) + 1):
                if tuple(w[a:b]) in windows:
                    hit |= set(range(a, b))
                    found |= windows[tuple(w[a:b])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


DOCS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short phrase"), (3, "a short, PHRASE? here"), (4, None), (5, ""),
        (6, "one"), (None, "alpha BETA gamma delta epsilon zeta eta theta iota kappa"), (7, "x y " * 30), (7, "x y " * 30), (8, "gamma delta"),
        (9, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (10, "déjà vu été 42 déjà vu été 42"), (11, "phrase short"), (12, "y x y x y x y x y x")]
ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short phrase"), (2, "Short phrase"), (3, None), (4, "?!"), (5, "ONE"),
         (None, "été 42"), (10, "x y " * 6), (11, "one two three"), (12, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu")]


@pytest.mark.parametrize("slice_bytes", [1 << 22, 40])
def test_small_tables(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(leaks, "SLICE_BYTES", slice_bytes)
    docs = spark.createDataFrame([(*r, "z", 0) for r in DOCS], "doc_id long, text string, items string, n_words int").coalesce(2)
    items = spark.createDataFrame([(*r, "z") for r in ITEMS], "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in leaks.contamination(docs, items).collect()), key=str)
    assert got == plain(DOCS, ITEMS)
    clean = {(r[0], r[1]) for r, p in zip(sorted(DOCS, key=str), plain(DOCS, ITEMS))}
    assert len(clean) == len(set(DOCS))
    kept = leaks.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(r[0]) for r in plain(DOCS, ITEMS) if not r[5])


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    items = spark.createDataFrame([(1, "of shared text paragraph3"), (2, "a")], "item_id long, text string")
    got = sorted((tuple(r) for r in leaks.contamination(edge_docs, items).collect()), key=str)
    assert got == plain([r[:2] for r in edge_rows], [(1, "of shared text paragraph3"), (2, "a")])
    assert not any(r.contaminated for r in leaks.contamination(edge_docs, items.limit(0)).collect())
    assert leaks.contamination(no_docs, items).collect() == []


def test_one_slice_at_a_time(spark, monkeypatch):
    """A slice's rows are written and its broadcast destroyed before the next one is made."""
    monkeypatch.setattr(leaks, "SLICE_BYTES", 40)
    alive, most, log = set(), [], []
    context, real = type(spark.sparkContext), leaks.stage

    def broadcast(self, value, plain=context.broadcast):
        made = plain(self, value)
        if isinstance(value, leaks.Phrases):
            alive.add(id(made))
            most.append(len(alive))
            end = made.destroy
            made.destroy = lambda *a, **k: (alive.discard(id(made)), log.append("destroy"), end(*a, **k))
        return made

    monkeypatch.setattr(context, "broadcast", broadcast)
    monkeypatch.setattr(leaks, "stage", lambda df, label: (real(df, label), log.append(label))[0])
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((tuple(r) for r in leaks.contamination(docs, items).collect()), key=str)
    assert got == plain(DOCS, ITEMS)
    assert len(most) > 2 and set(most) == {1} and not alive
    assert log == ["leaks-documents", *["leaks-hits", "destroy"] * len(most)]


def test_index_finds_all_places():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30, 400):
        text = np.append(rng.integers(1, 5, n), 0)
        index = fmindex.FMIndex(text, 6)
        for width in (1, 2, 3, 5):
            phrases = rng.integers(1, 6, (20, width))
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                places = [i for i in range(n - width + 1) if (text[i : i + width] == p).all()]
                assert sorted(index.locate(np.arange(a, b))) == places
