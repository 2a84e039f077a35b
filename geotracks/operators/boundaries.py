"""Fixed-schema administrative boundary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geotracks.functions.numbers import is_number_text
from geotracks.schemas import BOUNDARY_FIELDS, BOUNDARY_LEVELS, MULTIPOLYGON, WGS84

# Fixed value: how the boundary tables are called.
_TABLE = "g2013_2012_{level}"
#: Columns of a boundary table, in their order.
COLUMNS = ["ogc_fid", "wkb_geometry", *BOUNDARY_FIELDS]


def table_name(level: int) -> str:
    """Name of the boundary table of a level."""
    if level not in BOUNDARY_LEVELS:
        raise ValueError(f"level must be one of {BOUNDARY_LEVELS}")
    return _TABLE.format(level=level)


def load_boundaries(
    raw: DataFrame, level: int, existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split raw text features into rows that fit the table of ``level``, and the others.

    A feature needs a MultiPolygon in WGS84 (``geom_type``, ``srid``, ``wkb_geometry``), text
    within its length, numbers within their precision, and an ``ogc_fid`` not taken by
    ``existing`` or by an equal-id feature before it in the order of its own columns. Accepted
    rows have the ten columns of the table, and no other. Rejects are counted by ``ogc_fid`` and
    ``reason``.
    """
    table_name(level)
    reason = F.when(~F.col("geom_type").eqNullSafe("MultiPolygon"), "geometry type").when(
        ~F.col("srid").eqNullSafe(WGS84), "reference system"
    )
    for name, data_type in BOUNDARY_FIELDS.items():
        reason = reason.when(~_fits(F.col(name), data_type), name)
    reason = reason.when(F.col("ogc_fid").isNull(), "ogc_fid")
    checked = raw.withColumn("reason", reason)

    typed = checked.where("reason IS NULL").select(
        F.col("ogc_fid").cast("long").alias("ogc_fid"),
        F.col("wkb_geometry").cast(MULTIPOLYGON).alias("wkb_geometry"),
        *[_value(F.col(n), t).alias(n) for n, t in BOUNDARY_FIELDS.items()],
    )
    rest = [c for c in typed.columns if c != "ogc_fid"]
    # A repeated id keeps its least row; the aggregate reduces repeats before the shuffle.
    single = typed.groupBy("ogc_fid").agg(
        F.min(F.struct(*rest)).alias("_row"), F.count("*").alias("_copies")
    )
    repeats = single.where("_copies > 1").select(
        "ogc_fid", F.lit("repeated ogc_fid").alias("reason"), (F.col("_copies") - 1).alias("features")
    )
    accepted = single.select("ogc_fid", "_row.*").select(*COLUMNS)
    if existing is not None:
        taken = existing.select("ogc_fid")
        clash = accepted.join(taken, "ogc_fid", "left_semi").select(
            "ogc_fid", F.lit("repeated ogc_fid").alias("reason"), F.lit(1).cast("long").alias("features")
        )
        accepted = accepted.join(taken, "ogc_fid", "left_anti")
        repeats = repeats.unionByName(clash)
    rejected = (
        checked.where("reason IS NOT NULL")
        .groupBy(F.col("ogc_fid").cast("long").alias("ogc_fid"), "reason")
        .agg(F.count("*").alias("features"))
        .unionByName(repeats)
    )
    return accepted, rejected


def _fits(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.VarcharType):
        return text.isNull() | (F.length(text) <= data_type.length)
    return text.isNull() | (is_number_text(text) & text.try_cast(data_type).isNotNull())


def _value(text: Column, data_type: T.DataType) -> Column:
    return text if isinstance(data_type, T.VarcharType) else text.try_cast(data_type)
