"""Column builders over nested arrays."""

import pytest
from pyspark.sql import functions as F

from geotracks.functions import geometry as geo

TYPE = "name string, g array<array<struct<x:double,y:double>>>"
LINES = {
    "empty": [],
    "open": [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]],
    "closed": [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]],
    "eight": [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]],
    "joined": [[(0.0, 0.0), (1.0, 0.0)], [], [(1.0, 0.0), (2.0, 5.0)]],
    "gap": [[(0.0, 0.0), (1.0, 0.0)], [(3.0, 0.0), (2.0, 5.0)]],
    "branch": [[(0.0, 0.0), (1.0, 0.0)], [(1.0, 0.0), (2.0, 0.0)], [(1.0, 0.0), (1.0, 1.0)]],
    "two rings": [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)], [(5.0, 5.0), (6.0, 5.0), (5.0, 5.0)]],
    "line back": [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]],
    "null": None,
}


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(list(LINES.items()), TYPE)


def values(df, column):
    def plain(v):
        if isinstance(v, list):
            return [plain(i) for i in v]
        return tuple(v) if isinstance(v, tuple) else v

    return {r.name: plain(r.v) for r in df.select("name", column.alias("v")).collect()}


def test_line_merge(shapes):
    got = values(shapes, geo.line_merge(F.col("g")))
    assert got["joined"] == [[(0.0, 0.0), (1.0, 0.0), (2.0, 5.0)]]
    for same in ("open", "closed", "gap", "branch", "two rings", "empty", "null"):
        assert got[same] == LINES[same]


def test_closing(shapes):
    merged = geo.line_merge(F.col("g"))
    assert values(shapes, geo.is_closed(merged)) == {
        "empty": True, "open": False, "closed": True, "eight": True, "joined": False, "gap": False,
        "branch": False, "two rings": True, "line back": True, "null": None,
    }
    starts = values(shapes, geo.start_point(merged))
    assert starts["open"] == (0.0, 0.0) and starts["gap"] is None and starts["null"] is None
    closed = values(shapes, geo.close_ring(merged))
    assert closed["open"] == [LINES["open"][0] + [(0.0, 0.0)]]
    assert closed["closed"] == LINES["closed"] and closed["two rings"] == LINES["two rings"]
    assert closed["gap"] is None and closed["null"] is None


def test_polygon(shapes):
    got = values(shapes, geo.make_polygon(geo.close_ring(geo.line_merge(F.col("g")))))
    assert {n for n, v in got.items() if v is not None} == {"open", "closed", "eight", "joined"}
    with pytest.raises(Exception, match="a polygon needs"):
        values(shapes.where("name = 'line back'"), geo.make_polygon(F.col("g"), strict=True))
    assert values(shapes.where("name = 'closed'"), geo.make_polygon(F.col("g"), strict=True))["closed"]


def test_area(shapes):
    got = values(shapes.where("g IS NOT NULL AND size(g) > 0"), geo.ring_area(F.element_at("g", 1)))
    assert got["closed"] == 0.5 and got["open"] == 0.5
    assert got["eight"] == 0.0  # The two lobes cancel.


def test_points(spark):
    df = spark.createDataFrame([("2.5", 9)], "lon string, lat int")
    row = df.select(geo.make_point(F.col("lon"), F.col("lat")).alias("p"), geo.set_srid(4326).alias("s")).first()
    assert tuple(row.p) == (2.5, 9.0) and row.s == 4326
    point = geo.make_point(F.col("lon"), F.col("lat"))
    assert df.select(geo.ordinate(point, 0), geo.ordinate(point, 1)).first() == (2.5, 9.0)
    with pytest.raises(ValueError):
        geo.ordinate(point, 2)


def test_mercator(spark):
    df = spark.createDataFrame([(180.0, 0.0), (0.0, 45.0)], "x double, y double")
    got = df.select(geo.mercator_x(F.col("x")).alias("a"), geo.mercator_y(F.col("y")).alias("b")).collect()
    assert got[0].a == pytest.approx(20037508.342789244) and got[0].b == pytest.approx(0, abs=1e-6)
    assert got[1].b == pytest.approx(5621521.486192066)


def test_same_geometry(spark):
    df = spark.createDataFrame([([(1.0, 2.0)], [(1.0, 2.0)]), ([(1.0, 2.0)], None), (None, None)], "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    assert [r[0] for r in df.select(geo.same_geometry(F.col("a"), F.col("b"))).collect()] == [True, False, True]
