"""Tables derived from areas and plots: hulls, polygons, hectares, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotracks.operators import concave as concave_hull
from geotracks.operators import hulls, lines
from geotracks.plans.importer import Features


def track_hectares(tracks: DataFrame) -> DataFrame:
    """``name, hectares`` of the convex hull of every raw track, whatever its name."""
    per_track = hulls.hull_hectares(tracks, ["src", "ogc_fid", "name"])
    return per_track.select("src", "ogc_fid", "name", "hectares")


def convex(features: Features) -> DataFrame:
    """Feature columns, ``hectares`` of the convex hull, and the hull ring."""
    shapes = hulls.hull_hectares(features.vertices, ["fid"])
    return features.table.join(shapes, "fid", "left")


def concave(
    features: Features,
    area_pct: float = 0.0,
    shape_pct: float = 0.5,
    resolution: int = concave_hull.RESOLUTION,
) -> DataFrame:
    """Feature columns, ``hectares`` of one concave hull and the ring of another.

    Both are shrunk from the convex hull towards a share of its area; ``resolution`` bounds the
    cells in which a feature's shape is seen.
    """
    shares = {"area": area_pct, "shape": shape_pct}
    shapes = concave_hull.concave_hulls(features.vertices, ["fid"], shares, resolution=resolution).select(
        "fid",
        concave_hull.hectares(F.col("area")).alias("hectares"),
        F.col("shape").alias("wkb_geometry"),
    )
    return features.table.join(shapes, "fid", "left")


def polygon(features: Features, strict: bool = False, nested: bool = False) -> DataFrame:
    """Feature columns, ``hectares`` and vertex count of the polygon its line encloses.

    A feature that is not one closed line of four points or more has null hectares, or
    fails the query if ``strict``. The ring is the feature's vertices; ``nested`` adds it as
    an array, for layers whose rings are known to fit a row.
    """
    sums = lines.ring_sums(features.vertices, ["fid", "line_no"])
    shapes = sums.groupBy("fid").agg(
        F.count("*").alias("_lines"),
        F.sum("points").alias("points"),
        F.min("closed").alias("_closed"),
        F.min("hectares").alias("_hectares"),
    )
    valid = (F.col("_lines") == 1) & lines.is_ring(F.col("points"), F.col("_closed"))
    hectares = F.when(valid, F.col("_hectares"))
    if strict:
        hectares = hectares.when(
            ~F.coalesce(valid, F.lit(False)),
            F.raise_error(
                F.concat(F.lit("not a closed line of four points: fid "), F.col("fid"))
            ).cast("double"),
        )
    out = features.table.join(shapes, "fid", "left").select(
        *features.table.columns, hectares.alias("hectares"), "points"
    )
    if not nested:
        return out
    rings = lines.assemble(features.vertices, ["fid"], "_parts").select(
        "fid", F.get("_parts", F.lit(0)).alias("_ring")
    )
    return (
        out.join(rings, "fid", "left")
        .withColumn("wkb_geometry", F.when(F.col("hectares").isNotNull(), F.col("_ring")))
        .drop("_ring", "points")
    )


def polygon_vertices(features: Features) -> DataFrame:
    """The vertices, ``fid, pt_no, x, y``, of every feature that is a polygon."""
    whole = polygon(features).where("hectares IS NOT NULL").select("fid")
    return features.vertices.join(whole, "fid").select("fid", "pt_no", "x", "y")


def plot_polygon(plots: Features, strict: bool = False, nested: bool = False) -> DataFrame:
    """``polygon`` of plots in the column order of its view: plot_id before area_id."""
    out = polygon(plots, strict, nested)
    rest = [c for c in out.columns if c not in ("fid", "plot_id", "area_id")]
    return out.select("fid", "plot_id", "area_id", *rest)


def reconcile(areas: DataFrame, plots: DataFrame) -> DataFrame:
    """Hectares of an area, of all its plots, and the difference, once per (area, plot).

    Takes any two derivations with ``area_id`` and ``hectares``. The sum is one aggregate
    with map-side partials, so an area with very many plots is no burden.
    """
    sums = plots.groupBy("area_id").agg(F.sum("hectares").alias("plot_sum"))
    per_area = areas.select("area_id", "hectares").join(sums, "area_id")
    return per_area.join(plots.select("area_id"), "area_id").select(
        "area_id",
        "hectares",
        "plot_sum",
        (F.col("hectares") - F.col("plot_sum")).alias("difference"),
    )
