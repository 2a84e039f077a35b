"""Convex hulls of point groups of any size.

A group is never brought together as it is. Points are thinned where they are read (a
point that is no hull vertex of a subset is none of the whole), thinned again by
(group, salt) so that one huge group is shared by many tasks, and only the few points that
may still be vertices meet in one task, which reads them as a stream and keeps a running
hull of the group at hand.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from geotracks.functions import geometry as geo
from geotracks.schemas import LINE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tasks that share one group in the salted round.
SALTS = 32
#: Points thinned at a time; bounds the memory of a task.
BUFFER_ROWS = 250_000
_THIN_ROUNDS = 12


def convex_hulls(
    points: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", name: str = "wkb_geometry"
) -> DataFrame:
    """One open counter-clockwise hull ring per key group; points or segments when flat."""
    candidates = hull_candidates(points, keys, x, y)
    fields = [candidates.schema[k] for k in keys] + [T.StructField(name, LINE)]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    together = candidates.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(_ring_batches(list(keys), name), schema)


def hull_candidates(
    points: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y"
) -> DataFrame:
    """The points of each group that may be hull vertices: few, and all true vertices."""
    narrow = points.select(*keys, F.col(x).alias("x"), F.col(y).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL"
    )
    thin = _thin_batches(list(keys))
    read_side = narrow.mapInArrow(thin, narrow.schema)
    salt = F.pmod(F.xxhash64("x", "y"), F.lit(SALTS))
    return read_side.repartition(*keys, salt).mapInArrow(thin, narrow.schema)


def hull_hectares(
    points: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y"
) -> DataFrame:
    """Keys, ``hectares`` of the hull (projected after hulling) and the hull itself."""
    hulls = convex_hulls(points, keys, x, y)
    return hulls.select(
        *keys, geo.ring_hectares(F.col("wkb_geometry")).alias("hectares"), "wkb_geometry"
    )


def chains(
    code: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the lower and upper hull chains, by group code and ascending x.

    All groups shrink together: a point on the inner side of the chord between its
    neighbours is no vertex, so every such point goes in each round. With ``rounds`` the
    result may hold further points; without, it is exact.
    """
    order = np.lexsort((y, x, code))
    c, px, py = code[order], x[order], y[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (c[1:] != c[:-1]) | (px[1:] != px[:-1]) | (py[1:] != py[:-1])
    order = order[fresh]
    return (
        _shrink(order, code, x, y, 1.0, rounds),
        _shrink(order, code, x, y, -1.0, rounds),
    )


def _shrink(idx, code, x, y, side, rounds):
    done = 0
    while len(idx) > 2:
        if done == (rounds or 64):
            return idx if rounds else _scan(idx, code, x, y, side)
        a, b, c = idx[:-2], idx[1:-1], idx[2:]
        cross = (x[c] - x[a]) * (y[b] - y[a]) - (y[c] - y[a]) * (x[b] - x[a])
        drop = (code[a] == code[b]) & (code[b] == code[c]) & (side * cross >= 0)
        if not drop.any():
            break
        keep = np.ones(len(idx), dtype=bool)
        keep[1:-1] = ~drop
        idx = idx[keep]
        done += 1
    return idx


def _scan(idx, code, x, y, side):
    """One pass with a stack, for shapes that shrink by few points a round."""
    kept: list[int] = []
    for c in idx:
        while len(kept) > 1 and code[kept[-2]] == code[c]:
            a, b = kept[-2], kept[-1]
            cross = (x[c] - x[a]) * (y[b] - y[a]) - (y[c] - y[a]) * (x[b] - x[a])
            if side * cross < 0:
                break
            kept.pop()
        kept.append(c)
    return np.array(kept, dtype=np.int64)


def _group_codes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    code = np.zeros(table.num_rows, dtype=np.int64)
    for key in keys:
        indices = table[key].combine_chunks().dictionary_encode().indices
        part = indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        mixed = code * (part.max(initial=0) + 1) + part
        code = np.unique(mixed, return_inverse=True)[1].reshape(-1)
    return code


def _thin_batches(keys: list[str]) -> Callable:
    def thin(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        x, y = table["x"].to_numpy(), table["y"].to_numpy()
        lower, upper = chains(_group_codes(table, keys), x, y, _THIN_ROUNDS)
        kept = table.take(pa.array(np.union1d(lower, upper)))
        yield from kept.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BUFFER_ROWS:
                yield from thin(held)
                held, rows = [], 0
        if held:
            yield from thin(held)

    return run


def _ring_batches(keys: list[str], name: str) -> Callable:
    """Rows sorted by key to one ring per key, many groups at a time."""

    def rings(table: pa.Table, code, lower, upper) -> pa.RecordBatch:
        x, y = table["x"].to_numpy(), table["y"].to_numpy()
        inner = np.ones(len(upper), dtype=bool)
        inner[0] = inner[-1] = False
        turns = code[upper[1:]] != code[upper[:-1]]
        inner[1:] &= ~turns
        inner[:-1] &= ~turns
        back = upper[inner][::-1]
        walk = np.concatenate([lower, back])
        walk = walk[np.argsort(code[walk], kind="stable")]
        starts = np.flatnonzero(np.r_[True, code[walk[1:]] != code[walk[:-1]]])
        points = pa.StructArray.from_arrays(
            [pa.array(x[walk]), pa.array(y[walk])], names=["x", "y"]
        )
        lines = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(walk)], pa.int32()), points)
        firsts = table.select(keys).take(pa.array(walk[starts])).combine_chunks()
        columns = [firsts[k].combine_chunks() for k in keys]
        return pa.RecordBatch.from_arrays([*columns, lines], names=[*keys, name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, limit = 0, BUFFER_ROWS

        def finish(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, limit
            table = pa.Table.from_batches(held)
            code = _group_codes(table, keys)
            lower, upper = chains(code, table["x"].to_numpy(), table["y"].to_numpy())
            held, rows = [], 0
            if not last:
                # The last key may go on in the next batch: keep what is left of it.
                open_code = code[-1]
                rest = np.union1d(lower, upper)
                held = table.take(pa.array(rest[code[rest] == open_code])).to_batches()
                rows = sum(b.num_rows for b in held)
                # A hull of very many vertices is not gone through for every few new points.
                limit = max(BUFFER_ROWS, 2 * rows)
                lower, upper = lower[code[lower] != open_code], upper[code[upper] != open_code]
            if len(lower):
                yield rings(table, code, lower, upper)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= limit:
                yield from finish(last=False)
        if held:
            yield from finish(last=True)

    return run
