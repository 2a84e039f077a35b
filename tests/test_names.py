import pytest
from pyspark.sql import functions as F

from geotracks.functions import names
from geotracks.operators.classify import classify, new_names, winners

CASES = [
    ("AAA-1-2-3", "area", "AAA-1-2-3"),
    ("AAA-1-2-3-4", "plot", "AAA-1-2-3"),
    ("aaa-1-2-3", "area", "aaa-1-2-3"),
    ("A\nA-1-2-3", "area", "A\nA-1-2-3"),
    ("AAA-1-2-3\n", None, "AAA-1-2-3"),
    ("AAA-1-2-3-4\n", None, "AAA-1-2-3"),
    ("AA-1-2-3", None, None),
    ("AAAA-1-2-3", None, None),
    ("AAA-1-2-3-4-5", None, "AAA-1-2-3"),
    ("AAA-1-2-3-x", None, "AAA-1-2-3"),
    ("AAA-1-2", None, None),
    ("x AAA-1-2-3", None, None),
    ("", None, None),
    (None, None, None),
]


def test_kinds_and_keys(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, name string")
    got = df.select(
        "i", names.track_kind(F.col("name")).alias("kind"), names.plot_area_key(F.col("name")).alias("key")
    ).orderBy("i").collect()
    assert [(r.kind, r.key) for r in got] == [(k, a) for _, k, a in CASES]


def test_classify_gives_area_only_to_areas_and_plots(spark):
    df = spark.createDataFrame([("AAA-1-2-3-x",), ("AAA-1-2-3-4",)], "name string")
    assert {r.name: r.area_id for r in classify(df).collect()} == {
        "AAA-1-2-3-x": None,
        "AAA-1-2-3-4": "AAA-1-2-3",
    }


def test_winner_is_last_file_then_last_track(spark):
    df = spark.createDataFrame(
        [("a", 1, "N"), ("a", 9, "N"), ("b", 2, "N"), ("b", 3, "N"), ("a", 4, None)],
        "src string, ogc_fid long, name string",
    )
    assert [tuple(r) for r in winners(df).collect()] == [("N", "b", 3, 4)]


def test_new_names(spark):
    batch = spark.createDataFrame([("a",), ("b",)], "name string")
    known = spark.createDataFrame([("b",), ("c",)], "name string")
    assert [r.name for r in new_names(batch, known, ["name"]).collect()] == ["a"]
