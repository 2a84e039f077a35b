"""Concave hulls of point groups of any size.

The points of a group are put into square cells, and each cell is reduced to its convex hull by
``hulls``. Cells are quarters of quarters of the group's bounds: as small as they can be with no
more than ``resolution`` of them holding points. So their size follows the room that the points
take, and a far-off point costs a cell and coarsens nothing. A group is then at most
``resolution`` small rings, whatever its number of points, and one task digs its outline:

* start from the convex hull of everything;
* take the longest edge a-b, and the free point c inside of it that is nearest to it;
* replace a-b by a-c-b if c is nearer to one end than the ends are to each other, no point lies
  in between, and the new edges cross no outline or cell edge (so no triangle is cut out of a
  single cell, whose inner points are not at hand). If something stands in the way, its points
  are tried next, up to ``TRIES`` of them, else the edge stays. A cave is entered along its
  walls, so it may be deeper than its mouth is wide;
* stop a given hull when its area is at or below the wanted share of the convex area, or no
  edge is longer than a cell.

No cell hull is ever cut, so each hull contains every point; it lies inside the convex
hull; share 1 is the convex hull. Ties are broken by coordinates.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from geotracks.functions import geometry as geo
from geotracks.operators.hulls import chains, convex_hulls
from geotracks.operators.ordering import with_previous
from geotracks.schemas import LINE
from geotracks.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of a group that hold points, at most.
RESOLUTION = 4096
#: Points that are tried for an edge before it stays.
TRIES = 16
#: A point so near to an edge, as a share of its length, lies on it: the edge is parted there.
ON_EDGE = 1e-12
#: Quarterings of a group's bounds, at most.
DEPTH = 26


def concave_hulls(
    points: DataFrame,
    keys: Sequence[str],
    shares: dict[str, float],
    x: str = "x",
    y: str = "y",
    resolution: int = RESOLUTION,
) -> DataFrame:
    """One row per key group, with one open ring per entry of ``shares`` (name to share)."""
    keys = list(keys)
    cells = convex_hulls(_in_cells(points, keys, x, y, resolution), [*keys, "finest", "cell"], name="ring")
    fields = [T.StructField(k, cells.schema[k].dataType) for k in keys]
    schema = T.StructType([*fields, *[T.StructField(n, LINE) for n in shares]])
    # A fixed number of partitions: the work is in the digging, not in the bytes.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cells.repartition(tasks, *keys)
        .groupBy(*keys)
        .applyInArrow(_dig_group(keys, dict(shares)), schema)
    )


def hectares(ring: Column) -> Column:
    return geo.ring_hectares(ring)


def _in_cells(points: DataFrame, keys: list[str], x: str, y: str, resolution: int) -> DataFrame:
    """Points with the number of their cell, and the diagonal of their group's cells."""
    narrow = points.select(
        *keys, F.struct(*keys).alias("_group"), F.col(x).alias("x"), F.col(y).alias("y")
    ).where("x IS NOT NULL AND y IS NOT NULL")
    bounds = materialize(
        narrow.groupBy("_group").agg(
            F.min("x").alias("x0"),
            F.min("y").alias("y0"),
            F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side"),
        )
    )
    coded = narrow.join(bounds, "_group").withColumn("code", _interleaved(_place("x"), _place("y")))
    depths = _depths(coded.select("_group", "code").distinct(), resolution)
    sized = materialize(bounds.join(depths, "_group").select("_group", "x0", "y0", "side", "depth"))
    found = narrow.join(sized, "_group").withColumn("code", _interleaved(_place("x"), _place("y")))
    return found.select(
        *keys,
        (F.col("side") / F.pow(2.0, "depth") * 2**0.5).alias("finest"),
        F.expr(f"shiftright(code, 2 * ({DEPTH} - depth))").alias("cell"),
        "x",
        "y",
    )


def _place(name: str) -> Column:
    """Number of the smallest column or row of cells that a coordinate lies in."""
    share = F.coalesce(F.try_divide(F.col(name) - F.col(f"{name}0"), F.col("side")), F.lit(0.0))
    return F.least(F.floor(share * (1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("long")


def _interleaved(column: Column, row: Column) -> Column:
    """Bits of both, in turn: what is left of the number without its last pairs is a larger cell's."""

    def spread(v: Column) -> Column:
        # Each step halves the runs of bits that still lie together.
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF),
            (8, 0x00FF00FF00FF00FF),
            (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333),
            (1, 0x5555555555555555),
        ):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(column).bitwiseOR(F.shiftleft(spread(row), 1))


def _depths(codes: DataFrame, resolution: int) -> DataFrame:
    """For each group the number of quarterings that leaves at most ``resolution`` cells with points.

    In order of their codes, the points of a cell lie together. So a level has one cell more for
    each neighbour in that order that parts from the one before it at that level or above.
    """
    walked = with_previous(codes, F.col("code"), ["code"], ["_group"], "above")
    differing = F.length(F.bin(F.col("code").bitwiseXOR(F.col("above"))))
    level = F.when(F.col("above").isNull(), 0).otherwise(DEPTH + 1 - F.ceil(differing / 2))
    # At most one row per group and level.
    new_cells = walked.groupBy("_group", level.alias("level")).agg(F.count("*").alias("cells"))
    so_far = Window.partitionBy("_group").orderBy("level")
    cells = new_cells.withColumn("cells", F.sum("cells").over(so_far))
    first_above = F.min(F.when(F.col("cells") > resolution, F.col("level")))
    depth = F.coalesce(first_above - 1, F.lit(DEPTH)).cast("int")
    return cells.groupBy("_group").agg(depth.alias("depth"))


def _dig_group(keys: list[str], shares: dict[str, float]) -> Callable:
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).sort_by("cell")
        rings = table["ring"].combine_chunks()
        flat = rings.flatten()
        sizes = np.diff(rings.offsets.to_numpy())
        found = dig(
            flat.field("x").to_numpy(),
            flat.field("y").to_numpy(),
            sizes,
            list(shares.values()),
            table["finest"][0].as_py(),
        )
        columns = [pa.array([k.as_py()], k.type) for k in key]
        for xs, ys in found:
            ring = pa.StructArray.from_arrays([pa.array(xs), pa.array(ys)], names=["x", "y"])
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(xs)], pa.int32()), ring))
        yield pa.RecordBatch.from_arrays(columns, names=[*keys, *shares])

    return run


def dig(
    x: np.ndarray,
    y: np.ndarray,
    cell_sizes: np.ndarray,
    shares: list[float],
    finest: float = 0.0,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Outlines of the points for each share. Points come as rings, ``cell_sizes`` long each.

    Edges up to ``finest``, the size of a cell, stay: below it the shape is not known.
    """
    last = np.cumsum(cell_sizes) - 1
    follow = np.arange(1, len(x) + 1)
    follow[last] = last - cell_sizes + 1
    walls = np.flatnonzero(follow != np.arange(len(x)))
    cell = np.repeat(np.arange(len(cell_sizes)), cell_sizes)

    lower, upper = chains(np.zeros(len(x), dtype=np.int8), x, y)
    ring = np.concatenate([lower, upper[1:-1][::-1]])
    after = np.full(len(x), -1)
    after[ring] = np.roll(ring, -1)

    def outline() -> tuple[np.ndarray, np.ndarray]:
        walk = [int(ring[0])]
        while after[walk[-1]] != walk[0]:
            walk.append(int(after[walk[-1]]))
        return x[walk], y[walk]

    if len(ring) < 3:
        return [(x[ring], y[ring])] * len(shares)
    full = _area(x[ring], y[ring])
    area = full
    result: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    edges = [(-np.hypot(x[b] - x[a], y[b] - y[a]), x[a], y[a], int(a)) for a, b in zip(ring, after[ring])]
    heapq.heapify(edges)

    def settle() -> bool:
        for i, share in enumerate(shares):
            if i not in result and area <= share * full:
                result[i] = outline()
        return len(result) == len(shares)

    sides = _Segments(x, y, np.concatenate([walls, ring]), np.concatenate([follow[walls], after[ring]]), len(walls) + len(x))
    free = np.flatnonzero(after < 0)
    free_x, free_y = x[free], y[free]
    while edges and len(free) and not settle():
        length, _, _, a = heapq.heappop(edges)
        if -length <= finest:
            break
        b = int(after[a])
        ax, ay, bx, by = float(x[a]), float(y[a]), float(x[b]), float(y[b])
        from_ax, from_ay = free_x - ax, free_y - ay
        turns = (bx - ax) * from_ay - (by - ay) * from_ax
        to_ends = np.minimum(np.hypot(from_ax, from_ay), np.hypot(free_x - bx, free_y - by))
        ahead = ((to_ends > 0) & (turns >= 0)).nonzero()[0]
        if not len(ahead):
            continue
        far = _from_edge(from_ax[ahead], from_ay[ahead], bx - ax, by - ay)
        # Places in this order stand for the points: the nearest one comes first.
        order = np.lexsort((free_y[ahead], free_x[ahead], far))
        ahead, far = ahead[order], far[order]
        inside, turns, fits = free[ahead], turns[ahead], to_ends[ahead] < -length
        found = -1
        pool, seen, tries = [0], {0}, 0
        while pool and tries < TRIES:
            at = heapq.heappop(pool)
            tries += 1
            c = int(inside[at])
            if far[at] <= ON_EDGE * -length:
                found = at
                break
            if not fits[at] or cell[a] == cell[b] == cell[c]:
                continue
            hit = sides.crossed(a, c, b)
            between = _within(x, y, a, c, b, inside, turns)
            if not len(hit) and not between.any():
                found = at
                break
            # What stands in the way is closer to the cave's wall.
            between |= sides.with_end(hit, inside)
            for i in between.nonzero()[0].tolist():
                if i not in seen:
                    seen.add(i)
                    heapq.heappush(pool, i)
        if found < 0:
            continue
        c, turn = int(inside[found]), turns[found]
        after[a], after[c] = c, b
        sides.part(a, c, b)
        left = free != c
        free, free_x, free_y = free[left], free_x[left], free_y[left]
        area -= turn / 2
        for p, q in ((a, c), (c, b)):
            heapq.heappush(edges, (-np.hypot(x[q] - x[p], y[q] - y[p]), x[p], y[p], p))
    settle()
    final = outline()
    return [result.get(i, final) for i in range(len(shares))]


def _turn(x, y, a, b, c):
    return (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])


def _from_edge(x, y, dx, dy):
    """Distance of points, as seen from one end of an edge, from the edge that leads by dx, dy."""
    along = np.minimum(np.maximum((x * dx + y * dy) / (dx * dx + dy * dy), 0), 1)
    return np.hypot(x - along * dx, y - along * dy)


class _Segments:
    """Segments between points: cell edges, and the outline's edges while these are parted."""

    def __init__(self, x: np.ndarray, y: np.ndarray, froms: np.ndarray, tos: np.ndarray, most: int):
        self.x, self.y, self.size = x, y, len(froms)
        self.froms, self.tos = np.zeros(most, dtype=int), np.zeros(most, dtype=int)
        self.froms[: self.size], self.tos[: self.size] = froms, tos
        # Both ends' coordinates.
        self.end_x, self.end_y = np.zeros((2, most)), np.zeros((2, most))
        self.end_x[:, : self.size], self.end_y[:, : self.size] = (x[froms], x[tos]), (y[froms], y[tos])
        # Where a point's outline edge is: the outline comes after the cell edges.
        self.place = {int(p): i for i, p in enumerate(froms)}

    def part(self, a: int, c: int, b: int) -> None:
        """The outline's edge a-b becomes a-c and c-b."""
        for at, p, q in ((self.place[a], a, c), (self.size, c, b)):
            self.froms[at], self.tos[at] = p, q
            self.end_x[:, at], self.end_y[:, at] = (self.x[p], self.x[q]), (self.y[p], self.y[q])
            self.place[p] = at
        self.size += 1

    def crossed(self, a: int, c: int, b: int) -> np.ndarray:
        """Those that a-c or c-b meets other than at a shared end point."""
        p, q = np.array([a, c]), np.array([c, b])
        px, py = self.x[p], self.y[p]
        dx, dy = self.x[q] - px, self.y[q] - py
        by_line = (slice(None), None, None)
        side = dx[by_line] * (self.end_y[:, : self.size] - py[by_line]) - dy[by_line] * (self.end_x[:, : self.size] - px[by_line])
        # Most lie on one side of both lines; the rest is asked of few.
        line, k = (side[:, 0] * side[:, 1] <= 0).nonzero()
        froms, tos, p, q = self.froms[k], self.tos[k], p[line], q[line]
        other = ((froms != p) & (froms != q) & (tos != p) & (tos != q)).nonzero()[0]
        if not len(other):
            return other
        line, k, p, q = line[other], k[other], p[other], q[other]
        (fx, tx), (fy, ty) = self.end_x[:, k], self.end_y[:, k]
        dx, dy = tx - fx, ty - fy
        side_p = dx * (self.y[p] - fy) - dy * (self.x[p] - fx)
        side_q = dx * (self.y[q] - fy) - dy * (self.x[q] - fx)
        return k[(side_p * side_q <= 0) & side[line, :, k].any(axis=1)]

    def with_end(self, which: np.ndarray, points: np.ndarray) -> np.ndarray:
        """True for each of ``points`` that is an end of one of the segments ``which``."""
        marked = np.zeros(len(self.x), dtype=bool)
        marked[self.froms[which]] = True
        marked[self.tos[which]] = True
        return marked[points]


def _within(x, y, a, c, b, points, turns) -> np.ndarray:
    """The points inside the triangle a-c-b, its sides left out; ``turns`` are those of a-b."""
    return (turns > 0) & (_turn(x, y, b, c, points) > 0) & (_turn(x, y, c, a, points) > 0)


def _area(x: np.ndarray, y: np.ndarray) -> float:
    dx, dy = x - x[0], y - y[0]
    return abs(float(np.dot(dx, np.roll(dy, -1)) - np.dot(dy, np.roll(dx, -1)))) / 2
