"""Queries of this subpackage over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gradeweave.llm import codes, langid, leaks, mixing, neardup, ppm, repeats, rules, secrets, sites, slots, urls, whitening
from gradeweave.llm.shipping import ship


def _tables(operator: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names])

    return run


def _documents(operator: Callable[..., DataFrame], *others: str) -> Callable[[SparkSession, str], DataFrame]:
    return _tables(operator, "documents", *others)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": _documents(repeats.suffix_dedup),
        "op2_quality_rules": _documents(rules.quality_rules, "labels"),
        "op3_decontamination": _documents(leaks.contamination, "benchmark"),
        "op4_language_id": _documents(langid.languages),
        "op5_sharding": _documents(slots.shard),
        "op6_site_quality": _documents(sites.site_quality, "labels"),
        "op7_near_duplicates": _documents(neardup.near_duplicates),
        "op8_secret_scan": _documents(secrets.secret_scan),
        "op9_lm_scores": _documents(ppm.language_model_scores),
        "op10_mixing": _documents(mixing.mix),
        "op11_whitening": _tables(whitening.whitened, "embeddings"),
        "op12_url_filter": _tables(urls.url_filter, "pages"),
        "op13_vector_codes": _tables(codes.vector_codes, "embeddings"),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": leaks.SQL, "op10_mixing": mixing.SQL, "op13_vector_codes": codes.SQL}
