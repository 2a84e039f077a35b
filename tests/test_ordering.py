import pytest
from pyspark.sql import Window, functions as F

from geotracks.operators import ordering


@pytest.fixture(scope="module")
def rows(spark):
    # A third of all rows has key 0; null and text keys are there too.
    return (
        spark.range(6000)
        .select(
            F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 1, None).otherwise(F.col("id") % 7).alias("k"),
            F.concat(F.lit("v"), F.lpad((F.col("id") * 7919 % 6007).cast("string"), 5, "0")).alias("v"),
        )
        .cache()
    )


@pytest.fixture(params=[1, 13])
def ranges(spark, request):
    """Partitions of a range exchange; with 13 the hot key lies in several."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_number_rows_equals_a_window(rows, ranges):
    got = ordering.number_rows(rows, ["v"], ["k"], "n", "total")
    w = Window.partitionBy("k")
    want = rows.withColumn("n", F.row_number().over(w.orderBy("v")).cast("long")).withColumn(
        "total", F.count("*").over(w)
    )
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_number_rows_without_group(rows, ranges):
    got = ordering.number_rows(rows, ["v"], name="n", total="all").orderBy("v").collect()
    assert [(r.n, r["all"]) for r in got] == [(i, 6000) for i in range(1, 6001)]
    assert ordering.number_rows(rows.limit(0), ["v"], name="n").count() == 0


def test_previous_equals_lag(rows, ranges):
    got = ordering.with_previous(rows, F.struct("v"), ["v"], ["k"], "p")
    want = rows.withColumn("p", F.lag(F.struct("v")).over(Window.partitionBy("k").orderBy("v")))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rows_spread_over_the_ranges(rows, ranges):
    parts = [r["count"] for r in ordering._in_order(rows, ["k", "v"]).groupBy("_part").count().collect()]
    assert len(parts) == ranges and max(parts) < 2 * 6000 / ranges + 1


@pytest.mark.parametrize("index", [0, 1, 2999, 5999])
def test_feature_at_equals_the_sorted_rows(rows, ranges, index):
    want = rows.orderBy("k", "v").collect()[index]
    assert ordering.feature_at(rows, ["k", "v"], index).collect() == [want]
    assert ordering.feature_at(rows, ["k", "v"], 6000).count() == 0


def test_assign_fid_and_ordinal_access(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "name string")
    assert [tuple(r) for r in ordering.assign_fid(df, ["name"], 10).orderBy("fid").collect()] == [
        (11, "a"), (12, "b"), (13, "c"),
    ]
    assert [r.name for r in ordering.feature_at(df, ["name"], 1).collect()] == ["b"]
    assert ordering.feature_at(df, ["name"], 3).count() == 0
    assert [r.name for r in ordering.first_features(df, ["name"], 2).collect()] == ["a", "b"]


def test_materialize_writes_to_the_configured_folder(spark):
    from geotracks.session import materialize, work_folder

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured in work_folder(spark)
    df = spark.createDataFrame([(1, [(2.0, 3.0)])], "a int, g array<struct<x:double,y:double>>")
    stored = materialize(df)
    assert stored.schema == df.schema and stored.collect() == df.collect()
    assert all(f.startswith(f"file://{configured}") for f in stored.inputFiles())
