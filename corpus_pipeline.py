"""The corpus pipeline: stages over ``documents``, each on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from geotracks.llm import stages
from geotracks.session import work_folder

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("language", stages.keep_identified),
    ("near_dedup", stages.keep_one_of_each_group),
    ("mixing", stages.mix_sources),
    ("bpe", stages.encode),
]

#: Trained models and iterated components are no SQL; tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Every stage is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
