"""The registered queries of the training-text operators, by name, and their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadlake.llm import chat, decontam, langid, merkle, packing, pii, quality_model, quality_rules, secrets, simhash, suffix_dedup, toxicity, whitening
from leadlake.llm.sql import CHECKS  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": _over_documents(pii.digest),
    "op2_quality_rules": _over_documents(quality_rules.digest),
    "op3_secrets": _over_documents(secrets.digest),
    "op4_toxicity": lambda spark, sf_dir: toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")),
    "op5_quality_model": lambda spark, sf_dir: quality_model.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")),
    "op6_packing": _over_documents(packing.digest),
    "op7_decontamination": lambda spark, sf_dir: decontam.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")),
    "op8_suffix_dedup": _over_documents(suffix_dedup.digest),
    "op9_language": _over_documents(langid.digest),
    "op10_simhash": _over_documents(simhash.digest),
    "op11_merkle": _over_documents(merkle.digest),
    "op12_whitening": lambda spark, sf_dir: whitening.digest(_table(spark, sf_dir, "embeddings")),
    "op13_chat": lambda spark, sf_dir: chat.digest(_table(spark, sf_dir, "conversations")),
}
