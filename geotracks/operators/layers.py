"""Layer helpers: bounds, attribute filter, reference system, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotracks.functions import geometry as geo


def bounds(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row minx, miny, maxx, maxy of a vertex table or point layer.

    A layer with a column ``srid`` gives its reference system too; it must have a single one.
    """
    box = [F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy")]
    if "srid" not in points.columns:
        return points.agg(*box)
    several = F.raise_error(F.lit("a layer of several reference systems has no bounds")).cast("int")
    system = F.when(F.min("srid").eqNullSafe(F.max("srid")), F.min("srid")).otherwise(several)
    return points.agg(*box, system.alias("srid"))


def grid_envelope(box: DataFrame, side: float) -> DataFrame:
    """Envelope of a square grid centred on a bounds row, with its number of cells.

    There is always one column more than whole sides fit, so the grid covers the bounds
    even when they are an exact multiple of ``side``.
    """
    if not side > 0:
        raise ValueError("side must be positive")
    s = F.lit(float(side))
    counted = box.withColumns(
        {
            "nx": ((F.col("maxx") - F.col("minx")) / s).cast("long") + 1,
            "ny": ((F.col("maxy") - F.col("miny")) / s).cast("long") + 1,
        }
    )
    system = ["srid"] if "srid" in box.columns else []
    low = lambda a, b, n: F.col(a) + (F.col(b) - F.col(a)) / 2 - (F.col(n) * s) / 2
    return counted.select(
        "nx", "ny", low("minx", "maxx", "nx").alias("minx"), low("miny", "maxy", "ny").alias("miny"), *system
    ).select(
        "nx",
        "ny",
        "minx",
        "miny",
        (F.col("minx") + F.col("nx") * s).alias("maxx"),
        (F.col("miny") + F.col("ny") * s).alias("maxy"),
        *system,
    )


def square_grid(box: DataFrame, side: float) -> DataFrame:
    """The cells of ``grid_envelope``: number, column, row, extent and closed ring.

    Cells are numbered from 1, row by row from the lower left. They are made where they are
    used, by ``spark.range``; only the one envelope row passes through the driver.
    """
    frame = grid_envelope(box, side).first()
    spark = box.sparkSession
    if frame["nx"] is None:
        cells = _cells(spark.range(0), 1, 0.0, 0.0, side)
    else:
        cells = _cells(spark.range(frame["nx"] * frame["ny"]), frame["nx"], frame["minx"], frame["miny"], side)
    if "srid" not in box.columns:
        return cells
    return cells.withColumn("srid", F.lit(frame["srid"]).cast("int"))


def _cells(ids: DataFrame, nx: int, minx: float, miny: float, side: float) -> DataFrame:
    s = F.lit(float(side))
    placed = ids.select(
        (F.col("id") + 1).alias("cell_id"),
        (F.col("id") % nx).alias("col"),
        F.expr(f"id DIV {nx}").alias("row"),
    )
    extent = placed.select(
        "*",
        (F.lit(minx) + F.col("col") * s).alias("minx"),
        (F.lit(miny) + F.col("row") * s).alias("miny"),
        (F.lit(minx) + (F.col("col") + 1) * s).alias("maxx"),
        (F.lit(miny) + (F.col("row") + 1) * s).alias("maxy"),
    )
    ring = geo.square(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    return extent.withColumn("wkb_geometry", ring)


def where_equals(df: DataFrame, field: str, value: object) -> DataFrame:
    """Rows whose field equals the value; null equals nothing."""
    return df.where(F.col(field) == F.lit(value))


def srid_of(df: DataFrame) -> DataFrame:
    """The reference systems found in a layer's ``srid`` column, one row each."""
    return df.select("srid").distinct()


def count_features(df: DataFrame) -> DataFrame:
    """Number of features of a layer, as one row."""
    return df.agg(F.count("*").alias("features"))
