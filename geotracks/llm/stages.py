"""The stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

All but the last return the columns that they get. Extra columns pass through; columns that begin
with an underscore are the operators' own. An empty table gives an empty one. Null and empty texts:
toxicity scores them like texts without words, language rejects them as they hold no trigram, near
dedup keeps each of them, mixing drops what has no words, and BPE encodes them to no ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotracks.llm import bpe, language, minhash, mixing, toxicity
from geotracks.llm.common import load
from geotracks.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.toxic(docs, model).where("not _toxic").select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the source stands for the host."""
    return language.identify(docs, language.fit(docs), "text", "lang", "source").where("_language is not null").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row: that of the smallest id, null last.

    Of rows with that id the one with the smallest digest of its text stays, and of rows that
    repeat both one. Documents without words are no duplicates.
    """
    keyed = docs.withColumn("_key", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")))
    found = minhash.group(keyed.select("_key", "text"), "_key").where("kept")
    keys = materialize(found.groupBy(F.col("_key").alias("_least")).agg((F.max(F.col("print").isNull()) | (F.count("*") == 1)).alias("_all")))
    same = F.col("_key") == F.col("_least")
    # rows that no other row repeats need no comparison, and rows without words are all kept
    single = keyed.join(keys.where("_all"), same, "left_semi")
    once = keyed.join(keys.where("not _all"), same, "left_semi").dropDuplicates(["_key"])
    return single.unionByName(once).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = mixing.take(docs, docs.columns).where("_times > 0 and _size > 0")
    return rows.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoding's digests of each document."""
    return bpe.digests(bpe.encode(docs, bpe.default_tokenizer()))
