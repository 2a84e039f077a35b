"""Track import: classify, pick one track per name, upsert, merge and close lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from geotracks import schemas
from geotracks.operators import lines
from geotracks.operators.classify import classify, new_names, winners
from geotracks.operators.ordering import number_rows
from geotracks.session import materialize

LEVEL_KEYS = {"area": "area_id", "plot": "plot_id"}


@dataclass(frozen=True)
class Features:
    """Areas or plots: one row each in ``table``, geometry in ``vertices``."""

    table: DataFrame
    vertices: DataFrame

    @staticmethod
    def empty(spark: SparkSession, level: str) -> Features:
        table = schemas.AREAS if level == "area" else schemas.PLOTS
        return Features(
            spark.createDataFrame([], table), spark.createDataFrame([], _VERTICES)
        )


_VERTICES = "fid long, line_no int, pt_no long, x double, y double"


@dataclass(frozen=True)
class ImportResult:
    """New state of both levels. ``changed`` lists the features this batch wrote.

    ``status`` is False, and the state the one given, when there was nothing to import.
    """

    status: bool
    areas: Features
    plots: Features
    rejects: DataFrame
    changed: DataFrame
    fresh_vertices: DataFrame

    def level(self, level: str) -> Features:
        return self.areas if level == "area" else self.plots


def import_tracks(
    tracks: DataFrame,
    areas: Features | None = None,
    plots: Features | None = None,
    keep_clazz: bool = False,
    store_fresh: bool = False,
) -> ImportResult:
    """Upsert a staged batch of track vertices into areas and plots.

    Unseen names are appended with the next fid, in name order. Known names keep their fid,
    get the new geometry, and fall back to class 0 unless ``keep_clazz``. Other names are
    dropped. Of several tracks with one name the last (src, ogc_fid) is used. ``store_fresh`` stores
    the batch's vertices, for callers that read both levels or go on to import: else each reading
    joins all of them anew.
    """
    spark = tracks.sparkSession
    areas = areas or Features.empty(spark, "area")
    plots = plots or Features.empty(spark, "plot")
    # The one pass over all vertices before the final join: everything about names and
    # parts comes from this table, which has a row per track part.
    parts = materialize(lines.track_parts(tracks, ["src", "ogc_fid", "name"]))
    named = classify(winners(parts)).where("kind IS NOT NULL")
    changed = materialize(_changes(named, areas.table, plots.table))
    if changed.isEmpty():
        nothing = spark.createDataFrame([], "kind string, name string, reason string, tracks long")
        changed = changed.select("kind", "fid", "name")
        fresh = spark.createDataFrame([], f"kind string, {_VERTICES}")
        return ImportResult(not parts.isEmpty(), areas, plots, nothing, changed, fresh)

    keys = ["kind", "fid"]
    chosen = parts.drop("name").join(changed.select(*keys, "src", "ogc_fid"), ["src", "ogc_fid"])
    placed = lines.place_parts(materialize(chosen), keys)
    merged = lines.line_table(placed, keys)
    broken = lines.broken_tracks(merged, keys)
    whole = placed.join(broken, keys, "left_anti")
    fresh = lines.place_vertices(tracks, whole, ["src", "ogc_fid", "seg_no"], keys).unionByName(
        lines.closing_vertices(merged, keys)
    )
    if store_fresh:
        fresh = materialize(fresh)

    def state(level: str, old: Features) -> Features:
        mine = changed.where(F.col("kind") == level)
        kept = old.vertices.join(mine.select("fid"), "fid", "left_anti")
        return Features(
            _merged_table(old.table, mine, level, keep_clazz),
            kept.unionByName(fresh.where(F.col("kind") == level).drop("kind")),
        )

    rejects = (
        named.where("copies > 1")
        .select(
            "kind", "name", F.lit("repeated name").alias("reason"), (F.col("copies") - 1).alias("tracks")
        )
        .unionByName(
            changed.join(broken, keys, "left_semi").select(
                "kind",
                "name",
                F.lit("parts do not join").alias("reason"),
                F.lit(1).cast("long").alias("tracks"),
            )
        )
        .unionByName(
            changed.join(merged.select(*keys).distinct(), keys, "left_anti").select(
                "kind", "name", F.lit("no line").alias("reason"), F.lit(1).cast("long").alias("tracks")
            )
        )
    )
    return ImportResult(
        True,
        state("area", areas),
        state("plot", plots),
        rejects,
        changed.select("kind", "fid", "name"),
        fresh,
    )


def _changes(named: DataFrame, areas: DataFrame, plots: DataFrame) -> DataFrame:
    """Every named track with its fid: the known one, or the next of its level."""
    known = (
        areas.select(F.lit("area").alias("kind"), F.col("area_id").alias("name"), "fid")
        .unionByName(plots.select(F.lit("plot").alias("kind"), F.col("plot_id").alias("name"), "fid"))
    )
    last = {r["kind"]: r["fid"] for r in known.groupBy("kind").agg(F.max("fid").alias("fid")).collect()}
    start = F.when(F.col("kind") == "area", last.get("area", 0)).otherwise(last.get("plot", 0))
    fresh = number_rows(
        new_names(named, known, ["kind", "name"]), ["name"], by=["kind"], name="_ordinal"
    )
    added = fresh.withColumn("fid", (start + F.col("_ordinal")).cast("long")).withColumn(
        "is_new", F.lit(True)
    )
    matched = named.join(known, ["kind", "name"]).withColumn("is_new", F.lit(False))
    columns = ["kind", "fid", "name", "area_id", "src", "ogc_fid", "is_new"]
    return matched.select(*columns).unionByName(added.select(*columns))


def _merged_table(
    table: DataFrame, changes: DataFrame, level: str, keep_clazz: bool
) -> DataFrame:
    """The feature table with known names reset to class 0 and new ones appended."""
    if keep_clazz:
        updated = table
    else:
        hits = changes.where("NOT is_new").select("fid", F.lit(0).alias("_reset"))
        updated = table.join(hits, "fid", "left").select(
            *[F.coalesce("_reset", c).alias(c) if c == "clazz" else c for c in table.columns]
        )
    key = LEVEL_KEYS[level]
    added = changes.where("is_new").withColumns({"clazz": F.lit(0), key: F.col("name")})
    return updated.unionByName(added.select(*table.columns))
