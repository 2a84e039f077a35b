"""Geometry functions as Column builders over nested arrays, without UDFs.

They suit shapes held in one row. Anything that can outgrow a row (a track given as
points) goes through ``operators.lines`` and ``operators.hulls`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: sphere radius of the web Mercator projection, in metres.
EARTH_RADIUS = 6378137.0


def make_point(lon: Column, lat: Column) -> Column:
    """Point with x = longitude, y = latitude."""
    return F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"))


def set_srid(srid: int) -> Column:
    """Reference-system tag to keep beside a geometry; it changes no number."""
    return F.lit(srid).cast("int")


def ordinate(point: Column, dimension: int) -> Column:
    """x for dimension 0, y for dimension 1; any other dimension fails."""
    if dimension == 0:
        return point["x"]
    if dimension == 1:
        return point["y"]
    raise ValueError(f"a point has no ordinate {dimension}")


def line_merge(lines: Column) -> Column:
    """Join consecutive parts that touch at a node where exactly two part ends meet.

    Parts must come in walking order; ``operators.lines.merge_lines`` takes any order.
    """
    parts = F.filter(lines, lambda part: F.size(part) > 0)
    ends = F.flatten(
        F.transform(parts, lambda p: F.array(F.element_at(p, 1), F.element_at(p, -1)))
    )

    def step(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        node = F.element_at(part, 1)
        joins = (
            (F.size(done) > 0)
            & (F.try_element_at(F.try_element_at(done, F.lit(-1)), F.lit(-1)) == node)
            & (F.size(F.filter(ends, lambda e: e == node)) == 2)
        )
        longer = F.concat(last, F.slice(part, F.lit(2), F.size(part)))
        return F.when(
            joins,
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(part)))

    return F.aggregate(parts, F.slice(parts, 1, 0), step)


def is_closed(lines: Column) -> Column:
    """True when every part ends where it starts."""
    return F.forall(lines, lambda p: F.element_at(p, 1) == F.element_at(p, -1))


def start_point(lines: Column) -> Column:
    """First point of a single line; null for several parts or none."""
    return F.when(F.size(lines) == 1, F.element_at(F.element_at(lines, 1), 1))


def close_ring(lines: Column) -> Column:
    """Append the start point to an open single line; an open multi-line becomes null."""
    only = F.element_at(lines, 1)
    return F.when(is_closed(lines), lines).when(
        F.size(lines) == 1, F.array(F.concat(only, F.slice(only, 1, 1)))
    )


def make_polygon(lines: Column, strict: bool = False) -> Column:
    """Ring of a closed single line with at least four points, else null (or failure)."""
    only = F.try_element_at(lines, F.lit(1))
    valid = (F.size(lines) == 1) & is_closed(lines) & (F.size(only) >= 4)
    if not strict:
        return F.when(valid, only)
    return F.when(lines.isNull() | valid, only).otherwise(
        F.raise_error(F.lit("a polygon needs one closed line of four points or more")).cast(
            "array<struct<x:double,y:double>>"
        )
    )


def mercator_x(lon: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.log(F.tan(F.lit(0.25) * F.pi() + F.radians(lat) / 2))


def to_mercator(points: Column) -> Column:
    """WGS84 degrees to spherical Mercator metres, point by point."""
    return F.transform(
        points, lambda p: F.struct(mercator_x(p["x"]).alias("x"), mercator_y(p["y"]).alias("y"))
    )


def ring_area(ring: Column) -> Column:
    """Planar area inside a ring; the closing point may be present or left out."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    strips = F.zip_with(ring, following, lambda a, b: (b["x"] - a["x"]) * (a["y"] + b["y"]) / 2)
    return F.abs(F.aggregate(strips, F.lit(0.0), lambda total, strip: total + strip))


def ring_hectares(ring: Column) -> Column:
    """Hectares of a WGS84 ring measured on the Mercator plane."""
    return ring_area(to_mercator(ring)) / 10000


def convex_hull(points: Column) -> Column:
    """Convex hull ring (open, counter-clockwise from the lowest x) of an array of points."""
    ordered = F.array_sort(F.array_distinct(points))

    def turn(a: Column, b: Column, c: Column) -> Column:
        return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])

    def chain(pts: Column) -> Column:
        # On sorted points the vertices to drop before adding p are a suffix of the chain.
        def step(kept: Column, p: Column) -> Column:
            stay = F.filter(
                kept,
                lambda v, i: (i == 0) | (turn(F.get(kept, i - 1), v, p) > 0),
            )
            return F.concat(stay, F.array(p))

        return F.aggregate(pts, F.slice(pts, 1, 0), step)

    lower, upper = chain(ordered), chain(F.reverse(ordered))
    ring = F.concat(
        F.slice(lower, F.lit(1), F.greatest(F.size(lower) - 1, F.lit(0))),
        F.slice(upper, F.lit(1), F.greatest(F.size(upper) - 1, F.lit(0))),
    )
    return F.when(F.size(ordered) < 3, ordered).otherwise(ring)


def square(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed rectangular ring."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(
        corner(minx, miny), corner(maxx, miny), corner(maxx, maxy), corner(minx, maxy),
        corner(minx, miny),
    )


def same_geometry(a: Column, b: Column) -> Column:
    """Equality with equal coordinates in equal order; two nulls are equal."""
    return a.eqNullSafe(b)


def ring_edges(ring: Column) -> Column:
    """Pairs ``a, b`` of neighbouring points of an open ring, the last with the first."""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def boxed_edges(ring: Column, within: float = 1e-12) -> Column:
    """``ring_edges`` with their boxes, wide enough for all points that may be ``within`` of them."""

    def boxed(edge: Column) -> Column:
        found = [edge["a"].alias("a"), edge["b"].alias("b")]
        for axis in ("x", "y"):
            a, b = edge["a"][axis], edge["b"][axis]
            room = 2 * within + 1e-9 * (F.abs(a) + F.abs(b))
            found += [(F.least(a, b) - room).alias(f"{axis}_from"), (F.greatest(a, b) + room).alias(f"{axis}_to")]
        return F.struct(*found)

    return F.transform(ring_edges(ring), boxed)


def covers(ring: Column, x: Column, y: Column, within: float = 1e-12) -> Column:
    """True if a point lies in an open ring, or no farther than ``within`` from one of its edges."""
    return covered(boxed_edges(ring, within), x, y, within)


def covered(edges: Column, x: Column, y: Column, within: float = 1e-12) -> Column:
    """``covers`` by the ring's ``boxed_edges``, which are made once where a ring meets many points."""

    def crosses(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < at)

    def touches(edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        along = F.coalesce(F.try_divide((x - a["x"]) * dx + (y - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        near = (y >= edge["y_from"]) & (y <= edge["y_to"]) & (x >= edge["x_from"]) & (x <= edge["x_to"])
        return near & (F.hypot(x - a["x"] - share * dx, y - a["y"] - share * dy) <= within)

    found = F.exists(edges, touches) | (F.size(F.filter(edges, crosses)) % 2 == 1)
    return F.when(x.isNotNull() & y.isNotNull(), found)
