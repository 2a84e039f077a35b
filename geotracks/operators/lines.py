"""Line work on vertex tables: merging parts, closing rings, measuring polygons.

A track is spread over rows, so no step needs a whole track in one task. Part merging
works on a table with one row per part, and vertices are renumbered by one join with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from geotracks.functions import geometry as geo
from geotracks.session import materialize

#: Vertices of one line a task handles at a time when it needs neighbours.
CHUNK = 8192


@dataclass(frozen=True)
class MergedLines:
    """``vertices``: keys, line_no, pt_no, x, y. ``lines``: one row per merged line."""

    vertices: DataFrame
    lines: DataFrame


def track_parts(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per part: its size and its two end points. ``pt_no`` runs from 1."""
    return vertices.groupBy(*keys, "seg_no").agg(
        F.count("*").alias("points"),
        F.min_by("x", "pt_no").alias("sx"),
        F.min_by("y", "pt_no").alias("sy"),
        F.max_by("x", "pt_no").alias("ex"),
        F.max_by("y", "pt_no").alias("ey"),
    )


def merge_lines(vertices: DataFrame, keys: Sequence[str]) -> MergedLines:
    """Join parts at every node where exactly two part ends meet, in any order or direction.

    A merged line runs in the direction of most of its parts; a closed one starts at its
    first part. Parts of one point are no lines and drop out.
    """
    parts = materialize(track_parts(vertices, keys))
    placed = place_parts(parts, keys)
    return MergedLines(
        place_vertices(vertices, placed, [*keys, "seg_no"], keys), line_table(placed, keys)
    )


def line_table(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per merged line: keys, line_no, size, end points, closed."""
    first = lambda a, b: F.min_by(F.when(F.col("forward"), F.col(a)).otherwise(F.col(b)), "before")
    last = lambda a, b: F.max_by(F.when(F.col("forward"), F.col(a)).otherwise(F.col(b)), "before")
    return (
        placed.groupBy(*keys, "line_no")
        .agg(
            (F.sum(F.col("points") - 1) + 1).alias("points"),
            first("sx", "ex").alias("sx"),
            first("sy", "ey").alias("sy"),
            last("ex", "sx").alias("ex"),
            last("ey", "sy").alias("ey"),
        )
        .withColumn("closed", (F.col("sx") == F.col("ex")) & (F.col("sy") == F.col("ey")))
    )


def place_vertices(
    vertices: DataFrame, placed: DataFrame, on: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Vertices renumbered along their merged line; ``on`` joins a vertex to its part."""
    spots = placed.select(
        *dict.fromkeys([*on, *keys]),
        "line_no",
        "forward",
        "before",
        F.col("points").alias("part_points"),
    )
    inside = F.when(F.col("forward"), F.col("pt_no")).otherwise(
        F.col("part_points") - F.col("pt_no") + 1
    )
    return (
        vertices.select(*on, "pt_no", "x", "y")
        .join(spots, list(on))
        .withColumn("inside", inside)
        # The joint belongs to the part before it.
        .where("before = 0 OR inside > 1")
        .select(*keys, "line_no", (F.col("before") + F.col("inside")).alias("pt_no"), "x", "y")
    )


def place_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds line_no (lowest part of the line), direction and points-before to each part.

    ``parts`` should be a stored table; it is read several times. So is the result.
    """
    keys = list(keys)
    parts = parts.where("points > 1")
    sizes = parts.groupBy(*keys).agg(F.ceil(F.log2(F.count("*").cast("double"))).cast("int").alias("rounds"))
    longest = sizes.agg(F.max("rounds")).collect()[0][0] or 0
    if longest == 0:
        return parts.withColumns(
            {"line_no": F.col("seg_no"), "forward": F.lit(True), "before": F.lit(0).cast("long")}
        )
    states = _walk(_steps(parts, keys).join(sizes, keys), keys, longest)

    # Both directions of a part side by side (f: forward, b: backward); the walk back tells
    # what lies before it. Plain long columns, so that every aggregate is a hash aggregate.
    sided = [
        F.max(F.when(F.col("state") % 2 == odd, F.col(c))).alias(f"{side}_{c}")
        for odd, side in ((0, "f"), (1, "b"))
        for c in ("last", "span", "lowest", "lowest_at")
    ]
    both = states.groupBy(*keys, F.shiftright("state", 1).cast("int").alias("seg_no")).agg(
        *sided, F.max("edges").alias("edges"), F.max(F.col("ahead").isNotNull()).alias("loop")
    )
    # A chain is named by its end states in the direction whose name is lower, a loop by its
    # lowest part; ``along`` tells if the part runs forward in that direction.
    flip = lambda c: F.col(c).bitwiseXOR(F.lit(1).cast("long"))
    lower = (flip("b_last") < flip("f_last")) | (
        (flip("b_last") == flip("f_last")) & (F.col("f_last") <= F.col("b_last"))
    )
    along = F.when(F.col("loop"), F.col("f_lowest") % 2 == 0).otherwise(lower)
    loop_at = F.shiftright(F.least("f_lowest", "b_lowest"), 1)
    chained = both.withColumns(
        {
            "along": along,
            "chain_from": F.when(F.col("loop"), loop_at).otherwise(
                F.when(lower, flip("b_last")).otherwise(flip("f_last"))
            ),
            "chain_to": F.when(F.col("loop"), F.lit(-1).cast("long")).otherwise(
                F.when(lower, F.col("f_last")).otherwise(F.col("b_last"))
            ),
        }
    )
    chain = [*keys, "chain_from", "chain_to"]
    chains = chained.groupBy(*chain).agg(
        F.min("seg_no").alias("line_no"),
        F.min_by("along", "seg_no").alias("first_along"),
        F.sum(F.when(F.col("along"), 1).otherwise(-1)).alias("vote"),
        F.sum("edges").alias("chain_edges"),
    )
    # In a loop "along" already means: the way its lowest part runs forward.
    keep_way = (
        F.when(F.col("loop"), F.lit(True))
        .when(F.col("vote") == 0, F.col("first_along"))
        .otherwise(F.col("vote") > 0)
    )
    forward = F.col("along") == keep_way
    to_lowest = F.when(forward, F.col("f_lowest_at")).otherwise(F.col("b_lowest_at"))
    opposite_span = F.when(forward, F.col("b_span")).otherwise(F.col("f_span"))
    before = F.when(
        F.col("loop"),
        F.when(F.col("seg_no") == F.col("line_no"), F.lit(0)).otherwise(
            F.col("chain_edges") - to_lowest
        ),
    ).otherwise(opposite_span - F.col("edges"))
    placed = chained.join(chains, chain).select(
        *keys, "seg_no", "line_no", forward.alias("forward"), before.cast("long").alias("before")
    )
    return materialize(parts.join(placed, [*keys, "seg_no"]))


def _steps(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Walking states of each part (``2 * seg_no`` forward, ``+ 1`` backward) and their next."""
    forward = F.col("seg_no").cast("long") * 2
    # A part end is named by the state that leaves through it.
    end = lambda state, x, y: F.struct(
        state.alias("exit"), F.col(x).alias("px"), F.col(y).alias("py")
    )
    ends = parts.select(
        *keys, F.explode(F.array(end(forward, "ex", "ey"), end(forward + 1, "sx", "sy"))).alias("e")
    ).select(*keys, "e.*")
    nodes = (
        ends.groupBy(*keys, "px", "py")
        .agg(F.count("*").alias("degree"), F.min("exit").alias("p"), F.max("exit").alias("q"))
        .where("degree = 2 AND shiftright(p, 1) <> shiftright(q, 1)")
    )
    # Leaving through one end, a walk enters by the other: against the state that leaves there.
    turned = lambda c: F.col(c).bitwiseXOR(F.lit(1).cast("long")).alias("ahead")
    step = lambda a, b: F.struct(F.col(a).alias("state"), turned(b))
    links = nodes.select(
        *keys, F.explode(F.array(step("p", "q"), step("q", "p"))).alias("s")
    ).select(*keys, "s.*")
    states = parts.select(
        *keys,
        (F.col("points") - 1).alias("edges"),
        F.explode(F.array(forward, forward + 1)).alias("state"),
    )
    return states.join(links, [*keys, "state"], "left")


def _walk(steps: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """Pointer doubling: each round lets every state look twice as far ahead.

    A track takes part in as many rounds as its number of parts asks for, ``rounds``, and is out
    of the work then. A state that looks past the end of its line meets nothing, and is dealt
    out by its own number, so such states never come together.
    """
    states = materialize(
        steps.select(
            *keys,
            "rounds",
            "state",
            "edges",
            "ahead",
            F.col("edges").alias("span"),
            F.when(F.col("ahead").isNull(), F.col("state")).alias("last"),
            F.col("state").alias("lowest"),
            F.lit(0).cast("long").alias("lowest_at"),
        )
    )
    done = [states.where("rounds = 0")]
    for turn in range(1, longest + 1):
        active = states.where(F.col("rounds") >= turn)
        other = active.select(
            *keys,
            F.col("state").alias("_to"),
            *[
                F.col(c).alias(f"o_{c}")
                for c in ("ahead", "span", "last", "lowest", "lowest_at")
            ],
        )
        lower = F.col("o_lowest") < F.col("lowest")
        # States are not negative.
        looking = active.withColumn("_to", F.coalesce("ahead", -1 - F.col("state")))
        states = materialize(
            looking.join(other, [*keys, "_to"], "left").select(
                *keys,
                "rounds",
                "state",
                "edges",
                F.col("o_ahead").alias("ahead"),
                (F.col("span") + F.coalesce("o_span", F.lit(0))).alias("span"),
                F.coalesce("last", "o_last").alias("last"),
                F.when(lower, F.col("o_lowest")).otherwise(F.col("lowest")).alias("lowest"),
                F.when(lower, F.col("span") + F.col("o_lowest_at"))
                .otherwise(F.col("lowest_at"))
                .alias("lowest_at"),
            )
        )
        done.append(states.where(F.col("rounds") == turn))
    return reduce(DataFrame.unionByName, done).drop("rounds")


def broken_tracks(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of tracks that stay in several lines, not all closed: they have no ring."""
    return (
        lines.groupBy(*keys)
        .agg(F.count("*").alias("parts"), F.min("closed").alias("all_closed"))
        .where("parts > 1 AND NOT all_closed")
        .select(*keys)
    )


def closing_vertices(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The start point again, one past the end, for every track that is one open line."""
    single = lines.groupBy(*keys).agg(
        F.count("*").alias("parts"),
        *[F.first(c).alias(c) for c in ("line_no", "points", "sx", "sy", "closed")],
    )
    return single.where("parts = 1 AND NOT closed").select(
        *keys,
        "line_no",
        (F.col("points") + 1).alias("pt_no"),
        F.col("sx").alias("x"),
        F.col("sy").alias("y"),
    )


def close_lines(merged: MergedLines, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Vertices with open single lines closed, and the keys of tracks that have no ring.

    The vertices of those tracks are left out.
    """
    broken = broken_tracks(merged.lines, keys)
    kept = merged.vertices.join(broken, list(keys), "left_anti")
    return kept.unionByName(closing_vertices(merged.lines, keys)), broken


def ring_sums(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, vertex count, closed flag and Mercator hectares of each line, as one aggregate.

    Every edge needs two neighbours. Lines are cut in chunks of bounded size, with the
    vertex at a cut in both chunks, so the sum over edges needs no join and no long window.
    """
    keys = list(keys)
    projected = vertices.select(
        *keys,
        "pt_no",
        "x",
        "y",
        geo.mercator_x(F.col("x")).alias("mx"),
        geo.mercator_y(F.col("y")).alias("my"),
    )
    chunk = F.floor(F.col("pt_no") / CHUNK)
    chunked = projected.select(
        "*",
        F.explode(
            F.when(F.col("pt_no") % CHUNK == 0, F.array(chunk - 1, chunk)).otherwise(
                F.array(chunk)
            )
        ).alias("chunk"),
    )
    ahead = Window.partitionBy(*keys, "chunk").orderBy("pt_no")
    strip = (F.lead("mx").over(ahead) - F.col("mx")) * (F.lead("my").over(ahead) + F.col("my")) / 2
    own = F.col("chunk") == chunk
    per_line = (
        chunked.withColumn("strip", strip)
        .groupBy(*keys)
        .agg(
            F.count(F.when(own, 1)).alias("points"),
            (F.abs(F.sum("strip")) / 10000).alias("hectares"),
            F.min_by("x", "pt_no").alias("sx"),
            F.min_by("y", "pt_no").alias("sy"),
            F.max_by("x", "pt_no").alias("ex"),
            F.max_by("y", "pt_no").alias("ey"),
        )
    )
    return per_line.select(
        *keys,
        "points",
        ((F.col("sx") == F.col("ex")) & (F.col("sy") == F.col("ey"))).alias("closed"),
        "hectares",
    )


def is_ring(points: Column, closed: Column) -> Column:
    return closed & (points >= 4)


def geometry_prints(vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, number of vertices and a fingerprint of each geometry.

    Every vertex is hashed with its place, so the sum over a group is bound to the order though
    it can be taken in any: one aggregate with map-side partials. Equal geometries have equal
    prints; geometries of equal prints are almost surely equal.
    """
    at = ["line_no", "pt_no", "x", "y"]
    # -0.0 and 0.0 are one place
    place = [F.col(c) + F.lit(0.0) if c in ("x", "y") else F.col(c) for c in at]
    return vertices.groupBy(*keys).agg(
        F.count("*").alias("points"),
        F.bit_xor(F.xxhash64(*place)).alias("print"),
        F.bit_xor(F.xxhash64(F.lit(1), *place)).alias("print_2"),
    )


def same_geometries(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (fid_a, fid_b) with ``same``: the vertices of both features are equal, in order.

    Two features without vertices are the same. Prints rule out most others; where they are
    equal, vertices are compared one by one.
    """
    of = lambda t, side: geometry_prints(t, ["fid"]).select(
        F.col("fid").alias(f"fid_{side}"), F.struct("points", "print", "print_2").alias(f"print_{side}")
    )
    told = pairs.join(of(a, "a"), "fid_a", "left").join(of(b, "b"), "fid_b", "left")
    told = materialize(told.withColumn("alike", F.col("print_a").eqNullSafe(F.col("print_b"))))
    alike = told.where("alike AND print_a IS NOT NULL").select("fid_a", "fid_b").distinct()
    place = ["line_no", "pt_no"]
    both = (
        alike.join(a.select(F.col("fid").alias("fid_a"), *place, F.struct("x", "y").alias("p")), "fid_a")
        .join(b.select(F.col("fid").alias("fid_b"), *place, F.struct("x", "y").alias("q")), ["fid_b", *place])
    )
    equal = both.where("p = q").groupBy("fid_a", "fid_b").agg(F.count("*").alias("equal"))
    return told.join(equal, ["fid_a", "fid_b"], "left").select(
        "fid_a",
        "fid_b",
        (F.col("alike") & (F.coalesce("equal", F.lit(0)) == F.coalesce("print_a.points", F.lit(0)))).alias("same"),
    )


def assemble(vertices: DataFrame, keys: Sequence[str], name: str = "wkb_geometry") -> DataFrame:
    """Nested-array form of vertex tables, for layers whose geometry is known to fit a row."""
    lines = vertices.groupBy(*keys, "line_no").agg(
        F.array_sort(F.collect_list(F.struct("pt_no", "x", "y"))).alias("pts")
    )
    bare = F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return (
        lines.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("line_no", bare.alias("line")))).alias("parts"))
        .select(*keys, F.transform("parts", lambda p: p["line"]).alias(name))
    )


def disassemble(
    df: DataFrame, geometry: str = "wkb_geometry", line_name: str = "line_no"
) -> DataFrame:
    """Vertex table of a layer with nested multi-lines; all other columns are kept.

    Empty parts are left out first, so parts are numbered 0, 1, ... without gaps.
    """
    rest = [c for c in df.columns if c != geometry]
    filled = F.filter(geometry, lambda part: F.size(part) > 0)
    parts = df.select(*rest, F.posexplode(filled).alias(line_name, "_part"))
    return parts.select(
        *rest, line_name, F.posexplode("_part").alias("_pos", "_pt")
    ).select(
        *rest,
        line_name,
        (F.col("_pos") + 1).cast("long").alias("pt_no"),
        F.col("_pt.x").alias("x"),
        F.col("_pt.y").alias("y"),
    )
