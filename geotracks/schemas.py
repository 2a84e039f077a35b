"""Table schemas of the jobs.

Geometry is held in one of two layouts:

* **vertex table** - one row per track vertex. The layout of anything whose size is not
  bounded by the job itself, such as a track: a track of any length is spread over tasks.
* **nested array** - ``array<struct<x,y>>`` in one row, for shapes small by construction
  (points, grid cells, hull rings, boundary squares) or already one row in their source.

x is longitude and y latitude throughout.
"""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(POINT)
MULTILINE = T.ArrayType(LINE)
MULTIPOLYGON = T.ArrayType(T.ArrayType(LINE))

#: One row per vertex. (src, ogc_fid) names a track, src orders the files.
TRACK_VERTICES = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("ogc_fid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("seg_no", T.IntegerType()),
        T.StructField("pt_no", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

AREAS = T.StructType(
    [
        T.StructField("fid", T.LongType()),
        T.StructField("area_id", T.StringType()),
        T.StructField("clazz", T.IntegerType()),
    ]
)

PLOTS = T.StructType(
    [
        T.StructField("fid", T.LongType()),
        T.StructField("area_id", T.StringType()),
        T.StructField("plot_id", T.StringType()),
        T.StructField("clazz", T.IntegerType()),
    ]
)

#: Geometry of areas or plots: merged, closed lines.
FEATURE_VERTICES = T.StructType(
    [
        T.StructField("fid", T.LongType()),
        T.StructField("pt_no", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

SITES = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "store_name",
            "site_name",
            "site_number",
            "latitude",
            "longitude",
            "altitude",
            "gatewidth",
            "ownername",
            "comments",
            "countrygeofeature_id",
            "adm1geofeature_id",
            "adm2geofeature_id",
        )
    ]
)

#: Attribute columns of a boundary table, the same at the three levels.
BOUNDARY_FIELDS: dict[str, T.DataType] = {
    "status": T.VarcharType(37),
    "str_year": T.DecimalType(9, 0),
    "exp_year": T.DecimalType(9, 0),
    "disp_area": T.VarcharType(3),
    "adm0_code": T.DecimalType(9, 0),
    "adm0_name": T.VarcharType(100),
    "shape_leng": T.DecimalType(19, 11),
    "shape_area": T.DecimalType(19, 11),
}
BOUNDARY_LEVELS = (0, 1, 2)

WGS84 = 4326
