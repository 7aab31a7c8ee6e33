"""Held-out accuracy, rejection, and rows that have no language."""

import zlib

import numpy as np

from gradeweave.llm import langid

SF = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.languages(docs).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.99
    assert sum(r.rejected for r in got) / len(got) < 0.005
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(SF).limit(300).coalesce(1)
    first = langid.languages(docs).collect()
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 'zz' ELSE lang END AS lang", "'q' AS source")
    assert [tuple(r) for r in langid.languages(other).collect()] == [tuple(r) for r in first]


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = langid.languages(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows)
    by_id = {r.doc_id: r for r in got}
    for i in (2, 3, 4, 6):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert langid.languages(no_docs).collect() == []
    kept = langid.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert not {2, 3, 4, 6} & {r.doc_id for r in kept.collect()}
    unlabelled = edge_docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert {r.lang_pred for r in langid.languages(unlabelled).collect()} == {"und"}


def bags(text):
    """Buckets of all n-grams of a text, one by one."""
    folded = b" " + bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode()) + b" "
    keys = [(n, int.from_bytes(folded[i : i + n])) for n in langid.GRAMS for i in range(len(folded) - n + 1)]
    return [((k * 2654435761 + n * 40503) % 2**32 * 2246822519) % 2**32 >> (32 - langid.BUCKET_BITS) for n, k in keys]


def test_probabilities_against_sums_one_by_one(spark):
    docs = spark.read.parquet(SF)
    model = langid.train(docs, 200)
    texts = [r.text for r in docs.limit(40).collect()] + ["", "é", "Straße und " * 300_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    identified = {r._0: r for r in langid.identify(rows, model, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text):
            assert identified[i].lang_pred == "und"
            continue
        ids = bags(text)
        z = (model.weights[:, ids].astype(float).mean(1) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert identified[i].lang_pred == model.langs[p.argmax()] and abs(identified[i].score - p.max()) < 1e-6


def test_more_languages_than_dimensions():
    rng = np.random.default_rng(8)
    words = [["".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(20)] for _ in range(40)]
    pieces = [(" ".join(rng.choice(words[k], 30)).encode(), f"l{k:02d}") for k in range(40) for _ in range(30)]
    model = langid.fit([p for p, _ in pieces], [x for _, x in pieces])
    assert model.out is not None and model.weights.shape[0] == langid.DIM
    tests = [" ".join(rng.choice(words[k], 30)).encode() for k in range(40)]
    offsets = np.cumsum([0, *map(len, tests)])
    data = np.frombuffer(b"".join(tests), np.uint8)
    kinds, chances = model.best(data, offsets)
    assert np.mean(kinds == np.arange(40)) > 0.9 and ((chances > 0) & (chances <= 1)).all()
