"""Track import, flags and derivations."""

import pytest
from conftest import vertices
from pyspark.sql import functions as F

from geotracks.operators import flags
from geotracks.plans import derive
from geotracks.plans.importer import Features, import_tracks

SQUARE = [(0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01), (0, 0)]
OPEN = [(0, 0), (0.02, 0), (0.02, 0.02)]
GAP = [[(0, 0), (0.01, 0)], [(0.02, 0), (0.03, 0)]]


def table(features):
    return sorted(map(tuple, features.table.collect()))


@pytest.fixture(scope="module")
def first(spark):
    return import_tracks(
        vertices(
            spark,
            [
                ("BBB-1-1-1", [OPEN]),
                ("AAA-1-1-1", [SQUARE]),
                ("AAA-1-1-1-2", [OPEN]),
                ("AAA-1-1-1-1", GAP),
                ("not a track", [SQUARE]),
                (None, [SQUARE]),
            ],
            src="1.gpx",
        )
    )


def test_first_import(first):
    assert first.status
    assert table(first.areas) == [(1, "AAA-1-1-1", 0), (2, "BBB-1-1-1", 0)]
    assert table(first.plots) == [(1, "AAA-1-1-1", "AAA-1-1-1-1", 0), (2, "AAA-1-1-1", "AAA-1-1-1-2", 0)]
    assert [tuple(r) for r in first.rejects.collect()] == [("plot", "AAA-1-1-1-1", "parts do not join", 1)]
    rings = first.areas.vertices.where("fid = 2").orderBy("pt_no").collect()
    assert [(r.pt_no, r.x, r.y) for r in rings] == [(1, 0, 0), (2, 0.02, 0), (3, 0.02, 0.02), (4, 0, 0)]
    assert first.plots.vertices.where("fid = 1").count() == 0


def test_second_import_updates_and_appends(spark, first):
    areas = Features(flags.flag(first.areas.table, ["AAA-1-1-1", "BBB-1-1-1"], "area_id"), first.areas.vertices)
    batch = vertices(spark, [("AAA-1-1-1", [OPEN]), ("AAA-0-0-0", [SQUARE]), ("AAA-1-1-1-1", [SQUARE])], src="2.gpx")
    got = import_tracks(batch, areas, first.plots)
    assert table(got.areas) == [(1, "AAA-1-1-1", 0), (2, "BBB-1-1-1", 1), (3, "AAA-0-0-0", 0)]
    assert got.areas.vertices.where("fid = 1").count() == 4
    assert got.areas.vertices.where("fid = 2").count() == 4
    assert got.plots.vertices.where("fid = 1").count() == 5
    assert got.plots.vertices.where("fid = 2").count() == 4
    kept = import_tracks(batch, areas, first.plots, keep_clazz=True)
    assert table(kept.areas) == [(1, "AAA-1-1-1", 1), (2, "BBB-1-1-1", 1), (3, "AAA-0-0-0", 0)]


def test_importing_twice_is_importing_once(spark, first):
    batch = vertices(spark, [("BBB-1-1-1", [SQUARE]), ("CCC-1-1-1", [OPEN])], src="2.gpx")
    once = import_tracks(batch, first.areas, first.plots)
    twice = import_tracks(batch, once.areas, once.plots)
    assert table(once.areas) == table(twice.areas)
    assert once.areas.vertices.exceptAll(twice.areas.vertices).count() == 0
    assert twice.areas.vertices.exceptAll(once.areas.vertices).count() == 0


def test_repeated_name_uses_the_last_track(spark):
    batch = vertices(
        spark,
        [("b.gpx", "AAA-1-1-1", [SQUARE]), ("b.gpx", "AAA-1-1-1", [OPEN]), ("a.gpx", "AAA-1-1-1", [SQUARE])],
    )
    got = import_tracks(batch)
    assert table(got.areas) == [(1, "AAA-1-1-1", 0)]
    assert got.areas.vertices.count() == 4
    assert [tuple(r) for r in got.rejects.collect()] == [("area", "AAA-1-1-1", "repeated name", 2)]


def test_nothing_to_import(spark, first):
    empty = vertices(spark, [("x", [SQUARE])]).limit(0)
    got = import_tracks(empty, first.areas, first.plots)
    assert not got.status and got.areas is first.areas
    useless = import_tracks(vertices(spark, [("x", [SQUARE])]), first.areas, first.plots)
    assert useless.status and table(useless.areas) == table(first.areas) and useless.rejects.count() == 0


def test_flags(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 2)], "fid long, area_id string, clazz int")
    for ids in (["b", "b", "zz"], spark.createDataFrame([("b",), ("b",), ("zz",), (None,)], "id string")):
        got = flags.flag(df, ids, "area_id")
        assert got.schema["clazz"].dataType == df.schema["clazz"].dataType
        assert sorted(map(tuple, got.collect())) == [(1, "a", 0), (2, "b", 1), (3, None, 2)]
    assert (len(flags.EXCLUDED_PLOTS), len(set(flags.EXCLUDED_PLOTS))) == (55, 55)
    assert (len(flags.EXCLUDED_AREAS), len(set(flags.EXCLUDED_AREAS))) == (28, 19)


def test_derivations(spark, first):
    convex = {r.area_id: r for r in derive.convex(first.areas).collect()}
    polygon = {r.area_id: r for r in derive.polygon(first.areas).collect()}
    assert abs(convex["AAA-1-1-1"].hectares - polygon["AAA-1-1-1"].hectares) < 1e-6
    assert abs(convex["AAA-1-1-1"].hectares - 123.92) < 0.1
    concave = {r.area_id: r for r in derive.concave(first.areas).collect()}
    assert abs(concave["AAA-1-1-1"].hectares - convex["AAA-1-1-1"].hectares) < 1e-6
    assert derive.convex(first.areas).columns == ["fid", "area_id", "clazz", "hectares", "wkb_geometry"]
    assert derive.convex(first.plots).columns == ["fid", "area_id", "plot_id", "clazz", "hectares", "wkb_geometry"]
    nested = derive.plot_polygon(first.plots, nested=True)
    assert nested.columns == ["fid", "plot_id", "area_id", "clazz", "hectares", "wkb_geometry"]
    got = {r.plot_id: r for r in nested.collect()}
    assert got["AAA-1-1-1-1"].hectares is None and got["AAA-1-1-1-1"].wkb_geometry is None
    assert len(got["AAA-1-1-1-2"].wkb_geometry) == 4
    with pytest.raises(Exception, match="not a closed line"):
        derive.polygon(first.plots, strict=True).collect()


def test_reconcile(spark):
    areas = spark.createDataFrame([("A", 10.0), ("B", 5.0)], "area_id string, hectares double")
    plots = spark.createDataFrame([("A", 2.0), ("A", 3.0), ("C", 1.0)], "area_id string, hectares double")
    assert [tuple(r) for r in derive.reconcile(areas, plots).collect()] == [("A", 10.0, 5.0, 5.0)] * 2


def test_a_track_of_one_point_is_rejected(spark):
    known = import_tracks(vertices(spark, [("ABC-1-2-3", [[(0, 0), (1, 0), (1, 1), (0, 0)]])]))
    again = import_tracks(vertices(spark, [("ABC-1-2-3", [[(5, 5)]])], src="b.gpx"), known.areas, known.plots)
    assert [(r.name, r.reason) for r in again.rejects.collect()] == [("ABC-1-2-3", "no line")]


def test_stored_fresh_vertices_are_not_joined_again(spark):
    batch = vertices(spark, [("AAA-1-1-1", [SQUARE]), ("AAA-1-1-1-1", [OPEN]), ("AAA-1-1-1-2", GAP)])
    plain, stored = import_tracks(batch), import_tracks(batch, store_fresh=True)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "Join" in plan(plain.fresh_vertices) and "Join" not in plan(stored.fresh_vertices)
    for level in ("area", "plot"):
        got, want = stored.level(level), plain.level(level)
        assert table(got) == table(want)
        assert sorted(map(tuple, got.vertices.collect())) == sorted(map(tuple, want.vertices.collect()))


def test_tracks_of_a_session_are_staged_once(spark):
    from conftest import SMALL
    from geotracks import catalog

    paths = [catalog._staged(spark, SMALL).inputFiles() for _ in range(2)]
    assert paths[0] == paths[1] and paths[0]
    plan = catalog.flag_areas(spark, SMALL)._jdf.queryExecution().analyzed().toString()
    assert "Generate" not in plan
