"""The whole pipeline on a small odd table, against its stages one by one."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from geotracks.llm import bpe, stages

WORDS = "this that from with have were been their which would there about could other after first water people".split()


def some_docs():
    draw = random.Random(11)
    rows = []
    for i in range(400):
        words = draw.choices(WORDS, k=draw.randrange(8, 80))
        if i % 10 == 0:
            words[2:2] = ["vile", "filth"]
        rows.append((i, " ".join(words) + ".", "en", ["a", "b", None][i % 3], i))
    # copies, near copies, no id, no text, no words, a very long text
    rows += [(1000 + n, rows[1][1], "en", "a", 0) for n in range(40)]
    rows += [(2000, rows[71][1] + " end", "en", "b", 0), (None, rows[2][1], "en", "a", 0), (None, "a few words without any id at all here", None, None, None)]
    rows += [(3000, None, "en", "a", 0), (3001, "", None, "a", 0), (3002, " \n ", "en", None, 0), (3003, " ".join(draw.choices(WORDS, k=40_000)), "en", "c", 1)]
    labels = [(i, 1, int(i % 10 == 0)) for i in range(400)]
    return rows, labels


def test_run(spark, tmp_path):
    rows, labels = some_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("_extra", F.lit(1)).drop("_extra")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_dedup", "mixing", "bpe"]
    kept = docs
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, str(tmp_path))
        if name != "bpe":
            assert kept.columns == docs.columns
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(kept.count())
        if name == "toxicity":
            ids = {r.doc_id for r in kept.collect()}
            assert not [i for i in range(0, 400, 10) if i in ids] and len([i for i in range(400) if i % 10 and i in ids]) >= 350
        if name == "near_dedup":
            texts = [r.text for r in kept.collect()]
            assert texts.count(rows[1][1]) <= 1 and not (rows[71][1] in texts and rows[71][1] + " end" in texts)
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3]
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, result.collect())) == sorted(map(str, kept.collect()))
    want = bpe.digests(bpe.encode(spark.read.parquet(f"{tmp_path}/mixing"), bpe.default_tokenizer()))
    assert sorted(map(str, result.collect())) == sorted(map(str, want.collect()))


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for stage in (stages.drop_toxic, stages.keep_identified, stages.keep_one_of_each_group, stages.mix_sources):
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
