"""Classes against all pairs, sample agreement against similarity, components against a plain search."""

import numpy as np
import pyarrow as pa

from gradeweave.llm import components, neardup

SF = "/root/testdata/sf0.001/documents.parquet"


def check(docs, rows, slack=0.02):
    """Pairs clearly above the similarity share a class; classes are connected by pairs not clearly below."""
    got = neardup.near_duplicates(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    spark = docs.sparkSession
    idf = neardup.word_weights(neardup.distinct_texts(docs.select("doc_id", "text")))
    texts = sorted({t or "" for _, t in rows})
    a, b = np.triu_indices(len(texts), 1)
    sims = neardup.similarities(pa.array([texts[i] for i in a]), pa.array([texts[i] for i in b]), idf) if len(a) else np.zeros(0)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    classes = {}
    for i, t in rows:
        classes.setdefault(t or "", set())
    ids = {}
    for r in got:
        ids.setdefault(r.doc_id, set()).add(r.class_id)
    for i, t in rows:
        if i is not None and sum(j == i for j, _ in rows) == 1:
            classes[t or ""] |= ids[i]
    for t, c in classes.items():
        assert len(c) <= 1
    for i, j, s in zip(a, b, sims):
        if s >= neardup.SIMILARITY + slack and classes[texts[i]] and classes[texts[j]]:
            assert classes[texts[i]] == classes[texts[j]], s
        if s >= neardup.SIMILARITY - 1e-9:
            root[find(i)] = find(j)
    for i in range(len(texts)):
        for j in range(i):
            if classes[texts[i]] and classes[texts[i]] == classes[texts[j]]:
                assert find(i) == find(j)
    return got


def test_classes_on_the_test_table(spark):
    docs = spark.read.parquet(SF)
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = check(edge_docs, [r[:2] for r in edge_rows])
    assert {r.class_id for r in got if r.doc_id in (2, 3)} == {2}
    assert {(r.class_id, r.class_size) for r in got if r.doc_id in (7, 8)} == {(7, 3)}
    assert neardup.near_duplicates(no_docs).collect() == []
    kept = neardup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "4", "None", "5", "6", "7", "9", "10", "10"])


def test_a_large_group_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 16)
    rng = np.random.default_rng(1)
    base = [f"w{rng.integers(5000)}" for _ in range(300)]
    rows = []
    for i in range(200):
        w = list(base)
        for k in rng.choice(300, i % 4, replace=False):
            w[k] = f"new{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 120))) for i in range(30)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got if r.doc_id < 200} == {0}
    assert all(r.class_id == r.doc_id for r in got if r.doc_id >= 1000)


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(5)
    idf = np.linspace(1, 8, neardup.WORD_BUCKETS)
    for share in (0.5, 0.8, 0.95):
        got, want = [], []
        for _ in range(40):
            w = [f"w{x}" for x in rng.integers(0, 800, 400)]
            v = [x if rng.random() < share**0.2 else "v" + x for x in w]
            texts = pa.array([" ".join(w), " ".join(v)])
            data, offsets = neardup.utf8(texts)
            s = neardup.samples(*neardup.shingles(*neardup.word_hashes(data, offsets), idf), 2)
            got.append((s[0] == s[1]).mean())
            want.append(neardup.similarities(texts[:1], texts[1:], idf)[0])
        assert abs(np.mean(got) - np.mean(want)) < 0.03


def test_components(spark):
    rng = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for a, b in links for x in (a, b) if a != b}
    assert len(got) == len({r.node for r in got})


def family(rng, of, pairs, pool, own=9):
    """Texts with a template in common (mutual similarity about 0.75); of each pair the second has most of what is the first's own."""
    template = " ".join(f"t{x}" for x in rng.integers(0, 10**6, 30 * own))
    word = lambda: f"o{rng.integers(pool)}"
    texts = [template + " " + " ".join(word() for _ in range(own)) for _ in range(of)]
    for i in range(pairs):
        w = texts[2 * i].split()
        texts[2 * i + 1] = " ".join(w[: -2 * own // 3] + [word() for _ in range(2 * own // 3)])
    return texts


def test_links_inside_a_family_that_is_almost_similar(spark):
    rng = np.random.default_rng(11)
    texts = family(rng, 240, 40, 10**6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = neardup.word_weights(neardup.distinct_texts(docs))
    a, b = np.triu_indices(len(texts), 1)
    sims = neardup.similarities(pa.array([texts[i] for i in a]), pa.array([texts[i] for i in b]), idf)
    links = {(int(i), int(j)) for i, j, s in zip(a, b, sims) if s >= neardup.SIMILARITY}
    assert {(2 * i, 2 * i + 1) for i in range(40)} <= links and 0.72 < np.median(sims) < 0.79
    root = {(r.doc_id): r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [(i, j) for i, j in sorted(links) if root[i] != root[j]] == []
    assert len(set(root.values())) == len(texts) - len(links)
