"""Stages of the corpus pipeline on odd rows."""

from geotracks.llm import stages

LONG = " ".join(f"w{i}" for i in range(60))


def test_one_of_each_group_stays(spark):
    rows = [
        (1, LONG, "a"), (2, LONG, "a"), (3, LONG + " tail", "b"), (4, "other words here", "a"), (4, "other words here", "a"),
        (5, "", None), (5, "", None), (6, None, "a"), (None, "no id at all", "a"), (None, "no id at all", "a"), (7, "only one", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = stages.keep_one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    want = [rows[0], rows[3], rows[5], rows[6], rows[7], rows[8], rows[10]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert stages.keep_one_of_each_group(spark, docs.limit(0), "").count() == 0


def test_a_group_keeps_one_row_whatever_its_ids(spark):
    other = " ".join(f"v{i}" for i in range(60))
    third = " ".join(f"u{i}" for i in range(60))
    rows = [
        (None, LONG, "a"), (None, LONG + " tail", "a"), (1, LONG + " end", "b"),  # near copies, two of them without an id
        (2, other, "a"), (3, third, "a"), (3, other + " more", "b"),  # an id with two texts, one a near copy of another document
        (None, "null ids only " + " ".join(f"t{i}" for i in range(60)), "a"), (None, "null ids only " + " ".join(f"t{i}" for i in range(61)), "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(str, map(tuple, stages.keep_one_of_each_group(spark, docs, "").collect())))
    assert len(got) == 4 and {str(rows[i]) for i in (2, 3, 4)} <= set(got) and set(got) & {str(rows[6]), str(rows[7])}


def test_mixing_takes_each_row_on_its_own(spark):
    # a third of each source's rows has no id, and ids come up in all sources
    rows = [(None if i % 3 == 0 else i, f"the same words {i if i % 2 else 0}", s) for s, n in (("a", 60), ("b", 600), ("c", 900)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {"a": 720, "b": 0.0, "c": 0.0}  # a is held to three times its 240 words; the others share the rest, 2 to 1
    target["b"], target["c"] = 2 * (6240 - 720) / 3, (6240 - 720) / 3
    got = [tuple(r) for r in stages.mix_sources(spark, docs, "").collect()]
    for s in target:
        assert abs(4 * sum(r[2] == s for r in got) - target[s]) <= 4
    assert max(got.count(r) / rows.count(r) for r in set(got)) <= 3 and set(got) <= set(rows)
