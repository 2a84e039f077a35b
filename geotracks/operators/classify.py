"""Tracks to named areas and plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from geotracks.functions import names


def classify(tracks: DataFrame) -> DataFrame:
    """Adds ``kind`` (area, plot or null) and ``area_id`` (null unless one of the two)."""
    kind = names.track_kind(F.col("name"))
    return tracks.withColumn("kind", kind).withColumn(
        "area_id",
        F.when(F.col("kind") == "area", F.col("name")).when(
            F.col("kind") == "plot", names.plot_area_key(F.col("name"))
        ),
    )


def track_heads(vertices: DataFrame) -> DataFrame:
    """One row per track of a vertex table, reduced before the shuffle."""
    return vertices.select("src", "ogc_fid", "name").distinct()


def winners(tracks: DataFrame) -> DataFrame:
    """One track per name: the last by (src, ogc_fid); ``copies`` counts all of them."""
    return (
        track_heads(tracks)
        .where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.max(F.struct("src", "ogc_fid")).alias("win"), F.count("*").alias("copies"))
        .select("name", "win.src", "win.ogc_fid", "copies")
    )


def new_names(batch: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Batch rows not yet in the target.

    This is NOT IN; with names from a pattern match there is no null on
    either side, so the plain anti join says the same and can run as a hash join.
    """
    return batch.join(known.select(*on), list(on), "left_anti")
