"""Held-out verdicts, shrinkage, and rows without site or text."""

import numpy as np
from pyspark.sql import functions as F

from gradeweave.llm import sites


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    models = sites.train(docs, labels.where("doc_id % 3 > 0"))
    found = sites.evidence(docs.join(labels.where("doc_id % 3 = 0").select("doc_id"), "doc_id"), models, F.col("source"), F.col("lang"))
    got = found.withColumnsRenamed({"quality": "q", "toxic": "t"}).join(labels, "doc_id").collect()
    kept = lambda r: r.q >= 0 > r.t
    assert np.mean([kept(r) for r in got if r.quality == 1 and r.toxic == 0]) > 0.98
    assert np.mean([kept(r) for r in got if r.quality == 0]) < 0.05
    # about a quarter of these labels are on documents without any sign of it
    assert np.mean([kept(r) for r in got if r.toxic == 1]) < 0.3


def test_sparse_sites_shrink_to_their_priors(spark):
    rows = [(i, f"h{i % 4}", "p", 3.0 if i % 4 else -3.0) for i in range(400)] + [(900, "rare", "p", -3.0), (901, "rare", "p", -3.0), (902, None, None, 0.0)]
    found = spark.createDataFrame(rows, "doc_id long, host string, path string, quality double")
    got = {r.doc_id: r for r in sites.posteriors(found, "quality").collect()}
    assert len(got) == len(rows)
    assert got[0].quality_path < 0.2 < 0.8 < got[1].quality_path
    assert got[0].quality_host < got[900].quality_host < got[1].quality_host
    assert got[0].quality_posterior < -3 and got[1].quality_posterior > 3


def test_site_of_a_url(spark):
    host, path = sites.site(F.col("url"))
    urls = spark.createDataFrame([("http://Www.Example.com/a/b?x=1",), ("https://example.org",), (None,)], "url string")
    assert [tuple(r) for r in urls.select(host, path).collect()] == [("www.example.com", "a"), ("example.org", ""), (None, None)]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, None), (9, 0, 1), (None, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    for use in (labels, labels.limit(0)):
        got = sites.site_quality(edge_docs, use).collect()
        assert sorted(str((r.doc_id, r.host, r.path)) for r in got) == sorted(str((r[0], r[3], r[2])) for r in edge_rows)
        assert all(0 <= r.quality_score <= 1 and 0 <= r.toxic_score <= 1 for r in got)
    assert sites.site_quality(no_docs, labels).collect() == []
