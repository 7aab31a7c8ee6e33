"""What each stage leaves, and that the rows of the whole run follow from it."""

import re
import zlib
from collections import Counter

import corpus_pipeline
from gradeweave.llm import leaks, mixing
from gradeweave.sources.shared import stage

SF = "/root/testdata/sf0.001"


def test_stages_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = [docs]
    for name, step in corpus_pipeline.STAGES:
        left.append(stage(step(spark, left[-1], SF), f"test-{name}"))
    _, known, unlike, clean, mixed, placed = left
    assert all(x.columns == docs.columns for x in left[:-1])
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    lettered = {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert set(ids(known)) <= lettered and len(lettered) - len(ids(known)) <= 1
    texts = [r.text for r in unlike.collect()]
    assert len(texts) == len(set(texts)) and len(texts) <= len({r.text for r in known.collect()})
    hits = leaks.contamination(unlike, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids(clean) == Counter(r.doc_id for r in hits if not r.contaminated)
    times = {r.doc_id: round(r.taken / r.size) for r in mixing.mix(clean).collect() if r.size}
    assert ids(mixed) == Counter({i: n for i, n in times.items() if n})
    assert ids(placed) == ids(mixed)
    crc = {r.doc_id: zlib.crc32(r.text.encode()) for r in mixed.collect()}
    assert all(r.text_crc32 == crc[r.doc_id] for r in placed.collect())
    whole = corpus_pipeline.run(spark, SF)
    pick = lambda df: sorted(tuple(r) for r in df.select("doc_id", "size", "text_crc32", "law").collect())
    assert pick(whole) == pick(placed)


def test_edge_rows_and_an_empty_table(spark, edge_docs, no_docs):
    docs = edge_docs
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), f"edge-{name}")
        if name != "sharding":
            assert docs.columns == edge_docs.columns
        if name == "language_id":
            assert not {2, 3, 4, 6} & {r.doc_id for r in docs.collect()}
        if name == "near_dedup":
            left = Counter(r.doc_id for r in docs.collect())
            assert left[7] == 1 and 8 not in left and left[10] <= 2 and left[1] == 1
    assert all(r.size > 1 for r in docs.collect())
    for name, step in corpus_pipeline.STAGES:
        no_docs = stage(step(spark, no_docs, SF), f"none-{name}")
        assert no_docs.count() == 0
