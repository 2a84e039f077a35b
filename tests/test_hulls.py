import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from geotracks.functions import geometry as geo
from geotracks.operators import concave, hulls

POINT = st.tuples(st.integers(0, 12), st.integers(0, 12))


def brute(points):
    """Vertices of the hull: points that lie on no segment and in no triangle of others."""
    pts = sorted(set(points))

    def turn(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    vertices = set()
    for a in pts:
        for b in pts:
            if a == b:
                continue
            side = [turn(a, b, c) for c in pts]
            inside = [
                c for c, s in zip(pts, side) if s == 0 and not (
                    min(a, b) <= c <= max(a, b))
            ]
            if min(side) >= 0 and not inside:
                vertices |= {a, b}
    return vertices or set(pts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(POINT, min_size=1, max_size=25), min_size=1, max_size=5), st.booleans())
def test_chains_find_all_vertices(groups, rounds):
    code = np.concatenate([np.full(len(g), i) for i, g in enumerate(groups)])
    x = np.array([p[0] for g in groups for p in g], dtype=float)
    y = np.array([p[1] for g in groups for p in g], dtype=float)
    lower, upper = hulls.chains(code, x, y, 2 if rounds else None)
    for i, g in enumerate(groups):
        kept = {(int(x[k]), int(y[k])) for k in np.union1d(lower, upper) if code[k] == i}
        assert brute(g) <= kept
        if not rounds:
            assert kept == brute(g)


def test_stack_pass_agrees(monkeypatch):
    rng = np.random.default_rng(5)
    x, y = rng.random(500), rng.random(500)
    code = np.repeat(np.arange(5), 100)
    order = np.lexsort((y, x, code))
    for side in (1.0, -1.0):
        a = hulls._shrink(order, code, x, y, side, None)
        assert list(a) == list(hulls._scan(order, code, x, y, side))


def cloud(spark, sizes):
    rng = random.Random(3)
    rows = [
        (k, rng.gauss(0, 1), rng.gauss(0, 1)) for k, n in sizes.items() for _ in range(n)
    ]
    return spark.createDataFrame(rows, "k string, x double, y double")


def test_distributed_hull_equals_column_hull(spark, monkeypatch):
    df = cloud(spark, {"hot": 4000, "a": 300, "b": 2, "c": 1, "d": 40})
    df = df.unionByName(df.limit(50)).repartition(7)
    want = {
        r.k: r.h
        for r in df.groupBy("k").agg(F.collect_list(F.struct("x", "y")).alias("p"))
        .select("k", geo.convex_hull(F.col("p")).alias("h")).collect()
    }
    for buffer in (64, 250_000):
        monkeypatch.setattr(hulls, "BUFFER_ROWS", buffer)
        got = {r.k: r.wkb_geometry for r in hulls.convex_hulls(df, ["k"]).collect()}
        assert got == want


def test_hull_with_several_keys_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, 0.0, 0.0), (1, None, 1.0, 0.0), (1, None, 0.0, 1.0), (1, "z", 5.0, 5.0), (1, "z", None, 5.0)],
        "a int, b string, x double, y double",
    )
    got = {(r.a, r.b): [tuple(p) for p in r.wkb_geometry] for r in hulls.convex_hulls(df, ["a", "b"]).collect()}
    assert got == {(1, None): [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)], (1, "z"): [(5.0, 5.0)]}


def test_flat_groups_have_no_area(spark):
    df = spark.createDataFrame([("l", float(i), 2.0 * i) for i in range(9)] + [("p", 1.0, 1.0)] * 3, "k string, x double, y double")
    assert {r.k: r.hectares for r in hulls.hull_hectares(df, ["k"]).collect()} == {"l": 0.0, "p": 0.0}


def in_ring(ring, p):
    """On or inside, by winding with a tolerance on the edges."""
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        cross = (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
        dot = (p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)
        length = (bx - ax) ** 2 + (by - ay) ** 2
        if abs(cross) < 1e-9 and -1e-9 <= dot <= length + 1e-9:
            return True
        if (ay > p[1]) != (by > p[1]) and p[0] < (bx - ax) * (p[1] - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def shoelace(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1)), min_size=1, max_size=40))
def test_dug_outline_keeps_every_point(points):
    x = np.array([round(p[0], 3) for p in points])
    y = np.array([round(p[1], 3) for p in points])
    rings = concave.dig(x, y, np.ones(len(x), dtype=int), [0.0, 0.5, 1.0])
    areas = [shoelace(list(zip(*r))) for r in rings]
    assert areas[0] <= areas[1] + 1e-12 <= areas[2] + 2e-12
    lower, upper = hulls.chains(np.zeros(len(x)), x, y)
    assert len(rings[2][0]) == len(np.union1d(lower, upper))
    if len(set(zip(x, y))) < 3:
        assert areas == [0.0, 0.0, 0.0]
    for ring in rings:
        ring = list(zip(*ring))
        if len(ring) > 2 and shoelace(ring) > 1e-9:
            assert all(in_ring(ring, p) for p in zip(x, y))


def test_concave_hull_of_a_hot_group(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(6000):  # Half a ring.
        angle, r = rng.uniform(math.pi / 2, 3 * math.pi / 2), rng.uniform(0.8, 1.0)
        rows.append(("half", r * math.cos(angle), r * math.sin(angle)))
    rows += [("dot", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: r for r in concave.concave_hulls(df, ["k"], {"low": 0.0, "full": 1.0}).collect()}
    low = [tuple(p) for p in got["half"].low]
    full = [tuple(p) for p in got["half"].full]
    assert shoelace(low) < 0.6 * shoelace(full)
    assert all(in_ring(low, (x, y)) for k, x, y in rows if k == "half")
    assert [tuple(p) for p in got["dot"].low] == [(1.0, 1.0)]


def u_shape(step):
    """Outer and inner walls of a straight U, 1 wide, its cave 0.2 wide and 0.8 deep."""
    corners = [(0, 0), (1, 0), (1, 1), (0.6, 1), (0.6, 0.2), (0.4, 0.2), (0.4, 1), (0, 1), (0, 0)]
    points = []
    for (ax, ay), (bx, by) in zip(corners, corners[1:]):
        n = round(max(abs(bx - ax), abs(by - ay)) / step)
        points += [(ax + (bx - ax) * i / n, ay + (by - ay) * i / n) for i in range(n)]
    return points


def test_straight_walls_are_entered():
    x, y = map(np.array, zip(*u_shape(0.02)))
    low, full = concave.dig(x, y, np.ones(len(x), dtype=int), [0.0, 1.0])
    assert abs(shoelace(list(zip(*full))) - 1.0) < 1e-9
    assert abs(shoelace(list(zip(*low))) - 0.84) < 0.02
    assert all(in_ring(list(zip(*low)), p) for p in zip(x, y))


def test_a_far_off_point_coarsens_nothing(spark):
    near = u_shape(0.005)
    rows = [("near", *p) for p in near] + [("far", *p) for p in near] + [("far", 5e4, 5e4)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    cells = {r.k: r.n for r in concave._in_cells(df, ["k"], "x", "y", 512).groupBy("k").agg(F.count_distinct("cell").alias("n")).collect()}
    assert 128 < cells["near"] <= 512 and 128 < cells["far"] <= 512
    got = {r.k: [tuple(p) for p in r.low] for r in concave.concave_hulls(df, ["k"], {"low": 0.0}, resolution=512).collect()}
    assert abs(shoelace(got["near"]) - 0.84) < 0.05
    for k, ring in got.items():
        assert all(in_ring(ring, (x, y)) for name, x, y in rows if name == k)


@pytest.mark.parametrize("resolution", [1, 5, 40, 10_000])
def test_cells_are_as_fine_as_the_resolution_allows(spark, resolution):
    df = cloud(spark, {"hot": 900, "a": 30, "b": 2, "c": 1}).unionByName(cloud(spark, {None: 40}))
    cells = concave._in_cells(df, ["k"], "x", "y", resolution)
    counts = {r.k: (r.n, r.finest) for r in cells.groupBy("k", "finest").agg(F.count_distinct("cell").alias("n")).collect()}
    assert len(counts) == 5 and all(n <= resolution for n, _ in counts.values())
    if resolution == 10_000:
        assert [counts[k][0] for k in ("hot", "a", "b", "c", None)] == [900, 30, 2, 1, 40]
    if resolution == 40:
        assert counts["hot"][0] > 10


def test_the_hull_query_digs_once_though_it_reads_its_rings_twice(spark):
    from geotracks import catalog
    from geotracks.plans.importer import Features

    shape = u_shape(0.05)
    points = spark.createDataFrame([(1, x, y) for x, y in shape], "fid long, x double, y double")
    got = catalog._concave(Features(spark.range(1, 2).withColumnRenamed("id", "fid"), points))
    assert "FlatMapGroupsInArrow" not in got._jdf.queryExecution().analyzed().toString()
    assert [(r.fid, r.outside, r.ordered) for r in got.collect()] == [(1, 0, True)]


def test_covers_with_boxed_edges(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    at = [(0.5 * i, 0.5 * j) for i in range(-1, 10) for j in range(-1, 10)] + [(3.0, 2.5), (3.0, 2.5 + 1e-9), (1e9, 0.0)]
    shape = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])
    df = spark.createDataFrame(at, "x double, y double")
    got = {(r.x, r.y): r.kept for r in df.select("x", "y", geo.covers(shape, F.col("x"), F.col("y")).alias("kept")).collect()}
    assert got == {p: in_ring(ring, p) if p[1] != 2.5 + 1e-9 else False for p in at}
    null = spark.createDataFrame([(None, 1.0), (1.0, None)], "x double, y double")
    assert {r[0] for r in null.select(geo.covers(shape, F.col("x"), F.col("y"))).collect()} == {None}
