"""Importance resampling against plain arithmetic."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from geotracks.llm import resampling

SCHEMA = "doc_id long, text string, score int, rank string, _id int, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, buckets, longest, percent, least):
    where = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                counts[where(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for name, text in docs:
        words, found = features(text, longest)
        weight = sum(gain[where(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        rows.append((words, name, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = [(*r[1:], i + 1 if i < len(able) * percent // 100 else None) for i, r in enumerate(able)]
    return sorted(drawn + [(*r[1:], None) for r in rows if r[0] < least], key=str)


def some_docs():
    draw = random.Random(3)
    stock = ["Alpha", "beta", "GAMMA9", "d", "été", "naïve", "x" * 70, "a_b", "1", "東京", "same"]
    texts = [" ".join(draw.choices(stock, k=draw.randrange(0, 60))) for _ in range(150)]
    docs = list(enumerate([*texts, None, "", " \n\t", "word" * 9000, "Many words, " * 20_000]))
    # a third of the rows is one row, and some rows have no id
    return docs + [(7, "the same " * 15)] * 80 + [(None, "beta " * 25), (None, "beta " * 25), (None, "d " * 30)]


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 100_000, 100), (2, 50, 35)])
def test_ranks_equal_plain_arithmetic(spark, longest, buckets, percent):
    docs, target = some_docs(), ["alpha beta beta", None, "gamma9 東京"]
    table = spark.createDataFrame([(*d, 0, "r", 1, 2) for d in docs], SCHEMA).repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    got = resampling.resample(table, aim, buckets, longest, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, target, buckets, longest, percent, 20)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("a", "w " * 30), ("b", "w " * 30), (None, "w " * 30)], "name string, body string")
    got = resampling.resample(docs, docs, percent=100, id_col="name", text_col="body").collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3] and [r.weight for r in got] == [0, 0, 0]
    assert resampling.resample(docs.limit(0), docs, id_col="name", text_col="body").count() == 0
    assert resampling.resample(docs, docs.limit(0), id_col="name", text_col="body").count() == 3


def test_crc32_equals_zlib():
    draw = np.random.default_rng(1)
    data = draw.integers(0, 256, 5000).astype(np.uint8)
    begin = draw.integers(0, 4000, 300)
    end = begin + draw.integers(0, 90, 300)
    assert resampling.crc32(data, begin, end).tolist() == [zlib.crc32(data[a:b]) for a, b in zip(begin, end)]
