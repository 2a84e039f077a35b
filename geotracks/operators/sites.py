"""Site table to site points."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from geotracks.functions import geometry as geo
from geotracks.functions.numbers import to_double
from geotracks.schemas import SITES


def drop_header_rows(sites: DataFrame) -> DataFrame:
    """Without header lines that were read as data; rows with a null name stay."""
    return sites.where(~F.col("store_name").eqNullSafe(F.lit("store_name")))


def site_points(sites: DataFrame, permissive: bool = False) -> DataFrame:
    """Sites with both coordinates, which become one point ``the_geom`` (WGS84).

    Coordinates that are no numbers fail the query; ``permissive`` makes the point null.
    """
    located = drop_header_rows(sites).where("latitude <> '' AND longitude <> ''")
    point = geo.make_point(
        to_double(F.col("longitude"), permissive), to_double(F.col("latitude"), permissive)
    )
    if permissive:
        point = F.when(point["x"].isNotNull() & point["y"].isNotNull(), point)
    columns = []
    for name in SITES.names:
        if name == "latitude":
            columns.append(point.alias("the_geom"))
        elif name != "longitude":
            columns.append(F.col(name))
    return located.select(*columns)
