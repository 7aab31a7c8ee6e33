"""Scores against a plain trie, one symbol at a time, and base scores against plain counts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gradeweave.llm import ppm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def symbols(text):
    return [ppm.START] * ppm.ORDER + list(lower(text).encode()) + [ppm.END]


def plain_scores(training, texts):
    trie = defaultdict(Counter)
    for t in training:
        s = symbols(t)
        for i in range(ppm.ORDER, len(s)):
            for j in range(ppm.ORDER + 1):
                trie[tuple(s[i - j : i])][s[i]] += 1
    out = []
    for t in texts:
        s, total = symbols(t), 0.0
        for i in range(ppm.ORDER, len(s)):
            ruled_out = set()
            for j in range(ppm.ORDER, -1, -1):
                seen = {c: n for c, n in trie[tuple(s[i - j : i])].items() if c not in ruled_out}
                if not seen:
                    continue
                whole = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    total += math.log10(seen[s[i]] / whole)
                    break
                total += math.log10(len(seen) / whole)
                ruled_out |= set(seen)
            else:
                total -= math.log10(max(1, ppm.SYMBOLS - len(ruled_out)))
        out.append(total)
    return out


ROWS = [(1, "The cat sat on the mat."), (2, "the dog SAT on the log"), (3, None), (4, ""), (5, "ça va très bien ñandú"), (6, "\t \n"),
        (7, "xyzzy the cat"), (8, "aaaa aaaa aaab"), (9, "zebra quiz"), (10, "the cat sat on the cat"), (2, "the dog SAT on the log"),
        (None, "no name"), *[(i, f"number {i} of the dog") for i in range(11, 40)]]


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, score string, n_tokens int")
    got = sorted((tuple(r) for r in ppm.language_model_scores(docs).collect()), key=str)
    training = [t for i, t in rows if not held_out(i)]
    counts = Counter(w for t in training for w in [*WORD.findall(lower(t)), None])
    n, v = sum(counts.values()), len(counts)
    scores = plain_scores(training, [t for _, t in rows])
    want = []
    for (i, t), s in zip(rows, scores):
        own = [*WORD.findall(lower(t)), None]
        want.append((i, held_out(i), len(own), sum(w in counts for w in own), n,
                     sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), s))
    for a, b in zip(got, sorted(want, key=str)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-5, abs=1e-4)
    assert len(got) == len(rows)


def test_scores_match_a_plain_trie(spark):
    check(spark, ROWS)


def test_parts_of_the_trie_and_joined_keys_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ppm, "MAX_ENTRIES", 60)
    monkeypatch.setattr(ppm, "HEAD_WORDS", 4)
    monkeypatch.setattr(ppm, "HEAD_STRINGS", 30)
    check(spark, ROWS)


def test_without_a_head(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_WORDS", 0)
    monkeypatch.setattr(ppm, "HEAD_STRINGS", 0)
    check(spark, ROWS[:16])


def test_edge_rows(spark, edge_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_STRINGS", 100)
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, round(r.score, 2)) for r in ppm.language_model_scores(edge_docs).collect() if r.doc_id is not None)
    scores = plain_scores([r[1] for r in edge_rows if not held_out(r[0])], [r[1] for r in edge_rows])
    want = sorted((False, r[0], len(WORD.findall(lower(r[1]))) + 1, s) for r, s in zip(edge_rows, scores) if r[0] is not None)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-5, abs=0.01)


def test_what_the_driver_holds(spark, monkeypatch):
    """Only heads are gathered, texts are read twice however many strings there are, and no broadcast is left."""
    frame, context = type(spark.range(1)), type(spark.sparkContext)
    to_arrow, broadcast = frame.toArrow, context.broadcast
    gathered, alive, steps, stage = [], [], [], ppm.stage

    def arrow(self):
        gathered.append(to_arrow(self))
        return gathered[-1]

    def shared(self, value):
        found = broadcast(self, value)
        alive.append(found)
        destroy = found.destroy
        found.destroy = lambda *a: (alive.remove(found), destroy(*a))
        return found

    def staged(df, *rest):
        steps.append(df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        return stage(df, *rest)

    monkeypatch.setattr(frame, "toArrow", arrow)
    monkeypatch.setattr(context, "broadcast", shared)
    monkeypatch.setattr(ppm, "stage", staged)
    monkeypatch.setattr(ppm, "MAX_ENTRIES", 80)
    monkeypatch.setattr(ppm, "HEAD_STRINGS", 50)
    check(spark, ROWS[:16])
    assert gathered and max(map(len, gathered)) <= 50
    assert not alive
    assert sum(steps) == 2


def test_nothing_to_learn_from(spark):
    check(spark, [(i, "only held out") for i in range(60) if held_out(i)])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.language_model_scores(docs).collect() == []
