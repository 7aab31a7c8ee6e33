"""Removed spans against brute force, and the suffix order against sorting."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from gradeweave.llm import induced, repeats


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def check(got, rows, length):
    want = [(i, *x) for (i, *_), x in zip(rows, plain([r[1] for r in rows], length))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def made(seed, n=40):
    """Texts of shared passages: inside one text, at borders, overlapping, longer by a byte or shorter."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé "), rng.integers(2, 9)))
    passages = [" ".join(word() for _ in range(rng.integers(20, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.integers(1, 5)):
            p = passages[rng.integers(len(passages))]
            a = rng.integers(0, 30)
            parts.append(p[a : a + rng.integers(100, 320)] if rng.random() < 0.6 else " ".join(word() for _ in range(30)))
        texts.append("".join(parts))
    texts += ["ab" * 300, "z" * 201, "z" * 200, passages[0] * 3]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_spans_match_brute_force(spark, hot):
    rows = made(hot % 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(repeats.suffix_dedup(docs, hot=hot).collect(), rows, repeats.LENGTH)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    check(repeats.suffix_dedup(edge_docs).collect(), edge_rows, repeats.LENGTH)
    assert repeats.suffix_dedup(no_docs).collect() == []


def common(a, b, limit):
    k = 0
    while k < min(limit, len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


@pytest.mark.parametrize("memory, base, block", [(1 << 26, 1 << 22, 1 << 18), (100, 4, 8), (1000, 2, 16)])
def test_order_and_common_prefixes(tmp_path, monkeypatch, memory, base, block):
    """Small memory: queues on disk, and several rounds of induction."""
    monkeypatch.setattr(induced, "BASE", base)
    monkeypatch.setattr(induced, "BLOCK", block)
    rng = np.random.default_rng(0)
    for trial in range(60):
        n = int(rng.integers(1, 200))
        t = np.append(rng.integers(1, int(rng.integers(2, 7)), n), 0).astype(np.uint8)
        if trial % 3 == 0:
            t[:n] = np.tile(rng.integers(1, 4, int(rng.integers(1, 9))), 200)[:n]
        if trial % 5 == 0:
            t[:n] = np.repeat(t[:n], rng.integers(1, 30, n))[:n]
        folder = tmp_path / f"{trial}"
        folder.mkdir()
        limit = (3, 8, 20)[trial % 3]
        found = [(a.copy(), c.copy()) for a, c in induced.sorted_suffixes(t, induced.Disk(str(folder), memory), limit)]
        at, shared = (np.concatenate(x) for x in zip(*found))
        b = t.tobytes()
        assert sorted(at) == list(range(n))
        for k in range(1, n):
            x, y = b[at[k - 1] :], b[at[k] :]
            assert x[:limit] >= y[:limit]
            assert shared[k] == common(x, y, limit)


def test_shards_follow_the_bytes_of_stretches(spark, monkeypatch):
    assert repeats.shards_of(10, 200) == 200 and repeats.shards_of(6 << 30, 200) == (6 << 30) // repeats.SHARD
    rng = np.random.default_rng(8)
    passages = ["".join(rng.choice(list("abcde "), 300)) for _ in range(20)]
    docs = spark.createDataFrame([(i, "".join(rng.choice(passages, 2)) + str(i)) for i in range(60)], "doc_id long, text string")
    want, dealt, frame = sorted(repeats.suffix_dedup(docs).collect()), [], type(docs)
    repartition = frame.repartition
    monkeypatch.setattr(repeats, "SHARD", 1 << 10)
    monkeypatch.setattr(frame, "repartition", lambda df, n, *by: dealt.append((n, *by)) or repartition(df, n, *by))
    assert sorted(repeats.suffix_dedup(docs).collect()) == want
    assert max(n for n, *by in dealt if by == ["name"]) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_queue_of_many_small_blocks_is_taken_in_one_pass(tmp_path):
    class Counted(np.ndarray):
        lengths = 0

        def __len__(self):
            Counted.lengths += 1
            return super().__len__()

    queue = induced.Queue(induced.Disk(str(tmp_path)))
    for i in range(2000):
        queue.put(np.array([i]).view(Counted), np.zeros(1, np.uint8))
    assert [*queue.take()[0]] == [*range(2000)]
    assert Counted.lengths < 10 * 2000


def test_common_prefixes_of_bytes():
    rng = np.random.default_rng(9)
    text = rng.integers(0, 2, 5000).astype(np.uint8)
    text[1000:1300], text[-40:] = text[2000:2300], text[3000:3040]
    a, b = rng.integers(0, 4900, 3000), rng.integers(0, 4900, 3000)
    a[:9], b[:9] = [1000, 1001, 1290, 4960, 4960, 0, 4999, 4992, 1003], [2000, 2001, 2290, 3000, 3000, 0, 3039, 3032, 2003]
    for x, y, n in zip(a, b, induced.common_prefix(text, a, b, 200)):
        p, q = text[x : x + 200], text[y : y + 200]
        m = min(len(p), len(q))
        assert n == (m if (p[:m] == q[:m]).all() else (p[:m] != q[:m]).argmax())
