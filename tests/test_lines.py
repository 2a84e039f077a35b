import math
import random

from conftest import vertices
from pyspark.sql import functions as F

from geotracks.functions import geometry as geo
from geotracks.operators import lines


def merged(spark, tracks):
    got = lines.merge_lines(vertices(spark, tracks), ["name"])
    shapes = lines.assemble(got.vertices, ["name"]).collect()
    table = {}
    for r in got.lines.collect():
        table.setdefault(r.name, []).append((r.line_no, r.points, r.closed))
    return {r.name: [[tuple(p) for p in line] for line in r.wkb_geometry] for r in shapes}, table


def test_merge_in_any_order_and_direction(spark):
    path = [(i, i % 3) for i in range(41)]
    pieces = [path[i : i + 6] for i in range(0, 40, 5)]
    order = list(range(8))
    random.Random(1).shuffle(order)
    mixed = [pieces[i] if i % 4 else pieces[i][::-1] for i in order]
    shapes, table = merged(
        spark,
        [
            ("straight", [[(0, 0), (1, 0)], [(1, 0), (2, 0), (3, 1)]]),
            ("turned", [[(0, 0), (1, 0)], [(3, 1), (2, 0), (1, 0)]]),
            ("ring", [[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 1)], [(0, 0), (0, 1)]]),
            ("branch", [[(0, 0), (1, 0)], [(1, 0), (2, 0)], [(1, 0), (1, 1)]]),
            ("gap", [[(0, 0), (1, 0)], [(2, 0), (3, 0)]]),
            ("dot first", [[(0, 0)], [(0, 0), (5, 5)]]),
            ("mixed", mixed),
        ],
    )
    assert shapes["straight"] == [[(0, 0), (1, 0), (2, 0), (3, 1)]]
    assert shapes["turned"] == [[(0, 0), (1, 0), (2, 0), (3, 1)]]
    assert shapes["ring"] == [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]
    assert table["ring"] == [(0, 5, True)]
    assert len(shapes["branch"]) == 3 and len(shapes["gap"]) == 2
    assert shapes["dot first"] == [[(0, 0), (5, 5)]]
    assert shapes["mixed"] == [path]


def test_long_rings_and_chains(spark):
    def circle(n):
        pts = [(round(math.cos(2 * math.pi * i / n), 6), round(math.sin(2 * math.pi * i / n), 6)) for i in range(n)]
        return pts + pts[:1]

    ring = circle(37)
    order = list(range(37))
    random.Random(4).shuffle(order)
    parts = [[ring[i], ring[i + 1]] if i % 3 else [ring[i + 1], ring[i]] for i in order]
    shapes, table = merged(spark, [("ring", parts)])
    (line,) = shapes["ring"]
    assert len(line) == 38 and line[0] == line[-1] and set(line) == set(ring)
    assert [line[0], line[1]] == [parts[0][0], parts[0][1]]
    steps = {frozenset(p) for p in zip(line, line[1:])}
    assert steps == {frozenset(p) for p in zip(ring, ring[1:])}


def test_close_and_reject(spark):
    m = lines.merge_lines(
        vertices(
            spark,
            [
                ("open", [[(0, 0), (2, 0), (2, 2)]]),
                ("closed", [[(0, 0), (2, 0), (2, 2), (0, 0)]]),
                ("gap", [[(0, 0), (1, 0)], [(2, 0), (3, 0)]]),
                ("two rings", [[(0, 0), (1, 0), (1, 1), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]]),
            ],
        ),
        ["name"],
    )
    closed, broken = lines.close_lines(m, ["name"])
    assert [r.name for r in broken.collect()] == ["gap"]
    sums = {(r.name, r.line_no): r for r in lines.ring_sums(closed, ["name", "line_no"]).collect()}
    assert set(sums) == {("open", 0), ("closed", 0), ("two rings", 0), ("two rings", 1)}
    assert all(r.closed and r.points == 4 for r in sums.values())
    assert sums[("open", 0)].hectares == sums[("closed", 0)].hectares > 0


def test_ring_sums_do_not_depend_on_chunks(spark, monkeypatch):
    n = 5000
    ring = [(2 + 0.1 * math.cos(2 * math.pi * i / n), 9 + 0.1 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    df = vertices(spark, [("c", [ring + ring[:1]])]).withColumnRenamed("seg_no", "line_no")
    areas = []
    for chunk in (64, 8192):
        monkeypatch.setattr(lines, "CHUNK", chunk)
        (r,) = lines.ring_sums(df, ["name", "line_no"]).collect()
        areas.append(r.hectares)
        assert r.points == n + 1 and r.closed
    nested = lines.assemble(df, ["name"]).select(geo.ring_hectares(F.get("wkb_geometry", F.lit(0)))).first()[0]
    assert math.isclose(areas[0], areas[1], rel_tol=1e-9) and math.isclose(areas[0], nested, rel_tol=1e-9)


def test_area_ignores_start_and_direction(spark):
    ring = [(2.0, 9.0), (2.3, 9.1), (2.2, 9.4), (2.05, 9.2)]
    turned = ring[2:] + ring[:2]
    df = vertices(
        spark, [(n, [r + r[:1]]) for n, r in (("a", ring), ("b", turned), ("c", ring[::-1]))]
    )
    got = [r.hectares for r in lines.ring_sums(df, ["name", "seg_no"]).collect()]
    assert max(got) - min(got) < 1e-6 * max(got)


def test_disassemble_is_the_inverse(spark):
    df = vertices(spark, [("a", [[(0, 0), (1, 1)], [(2, 2), (3, 3), (4, 4)]])]).withColumnRenamed("seg_no", "line_no")
    nested = lines.assemble(df, ["name"])
    back = lines.disassemble(nested)
    assert back.exceptAll(df.select("name", "line_no", "pt_no", "x", "y")).count() == 0
    empty = spark.createDataFrame([("b", [[], [(7.0, 8.0)]])], "name string, wkb_geometry array<array<struct<x:double,y:double>>>")
    assert [tuple(r) for r in lines.disassemble(empty).collect()] == [("b", 0, 1, 7.0, 8.0)]


def test_same_geometries(spark):
    layout = "fid long, line_no int, pt_no long, x double, y double"
    line = [(0, 1, 0.0, 0.0), (0, 2, 1.0, 0.0), (1, 1, 5.0, 5.0)]
    a = [(fid, *p) for fid in range(1, 7) for p in line]
    changed = {
        2: [(0, 1, 1.0, 0.0), (0, 2, 0.0, 0.0), line[2]],  # turned round
        3: line[:2],  # a part less
        4: [(0, 1, -0.0, 0.0), *line[1:]],  # the same place
        5: [line[0], line[1], (1, 1, 5.0, 5.0 + 1e-12)],
        6: [],
    }
    b = [(fid, *p) for fid in range(1, 7) for p in changed.get(fid, line)]
    pairs = spark.createDataFrame([(i, i) for i in range(1, 9)] + [(1, 2), (3, 1), (1, 1)], "fid_a long, fid_b long")
    found = lines.same_geometries(spark.createDataFrame(a, layout), spark.createDataFrame(b, layout), pairs)
    got = sorted(map(tuple, found.collect()))
    # 7 and 8 have no vertices on either side, and (1, 1) is asked for twice
    want = [(1, 1, True), (1, 1, True), (1, 2, False), (2, 2, False), (3, 1, True), (3, 3, False), (4, 4, True), (5, 5, False), (6, 6, False), (7, 7, True), (8, 8, True)]
    assert got == want
