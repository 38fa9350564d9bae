"""The documents made ready for training, in five stages: language, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from leadlake.llm import decontam, langid, packing, pii, simhash
from leadlake.llm.common import shared_folder
from leadlake.session import configure


def recognised_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like none of the learned languages, go."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return simhash.first_of_each_group(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked by their kind."""
    return pii.mask_pii(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, each with its place in a training sequence."""
    return packing.digest(docs)


STAGES = [
    ("language", recognised_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("personal_data", personal_data),
    ("packing", packed_sequences),
]

# Learned profiles, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Each result is stored as Parquet in the shared folder of spark.checkpoint.dir and read again by the next stage."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
