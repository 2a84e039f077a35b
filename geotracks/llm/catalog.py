"""The queries of this folder, with production parameters over whole tables, and check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotracks.llm import ann, bpe, conversations, credentials, embeddings, language, licenses, minhash, mixing, resampling, sharding, toxicity, urls
from geotracks.llm.checks import CHECKS  # noqa: F401 - the entry file takes it from here
from geotracks.llm.common import load


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, "verdict string, host string, path string")
    return urls.judge(load(spark, sf_dir, "pages"), rules)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op3_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(load(spark, sf_dir, "documents"), bpe.default_tokenizer()))


def op4_learned_partitions_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(load(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op5_sorted_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link(load(spark, sf_dir, "embeddings"))


def op6_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by their text, markup and address; profiles come from the labelled documents."""
    pages = load(spark, sf_dir, "pages")
    rows = pages.select(
        "page_id", urls.parse(F.col("url"))[0].alias("host"), language.declared_language(F.col("html")).alias("declared"),
        language.page_text(F.col("html")).alias("text"),
    )
    found = language.identify(rows, language.fit(load(spark, sf_dir, "documents")), "text", "declared", "host")
    return found.select(
        "page_id", "host", "declared", F.col("_language").alias("language"), F.col("_text_language").alias("text_language"),
        F.round("_probability", 6).alias("probability"),
    )


def op7_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.group(load(spark, sf_dir, "documents")).drop("print")


def op8_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.DEFAULT_THRESHOLD).cast("int").alias("predicted"),
    )


def op9_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(load(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op11_block_table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(rows), rows)


def op12_regular_sampling_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_ownership_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_source_mixing,
        op3_word_table_bpe,
        op4_learned_partitions_ann,
        op5_sorted_projection_dedup,
        op6_language_evidence,
        op7_bottom_k_near_dedup,
        op8_convolutional_toxicity,
        op9_jump_sharding,
        op10_license_scan,
        op11_block_table_repair,
        op12_regular_sampling_resampling,
        op13_ownership_secret_scan,
    )
}
