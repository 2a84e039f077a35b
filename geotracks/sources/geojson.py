"""GeoJSON feature collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from geotracks.schemas import LINE, MULTILINE, MULTIPOLYGON, POINT
from geotracks.sources.tables import create_table

_PAIR = T.ArrayType(T.DoubleType())
# Nesting of the coordinates of each geometry type.
_DEPTH = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: T.StructType | None = None,
    lines: bool = False,
) -> DataFrame | None:
    """One row per feature: the properties, ``geom_type`` and ``coordinates`` as JSON text.

    ``properties`` is the schema of the attributes; without it Spark infers one over all
    features. ``lines`` reads newline-delimited features, which split across tasks; a file
    with one collection is parsed by one task. An empty collection gives None.
    """
    if properties is None:
        properties = _inferred(spark, path, lines)
        if properties is None:
            return None
    feature = T.StructType(
        [
            T.StructField("properties", properties),
            T.StructField(
                "geometry",
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        # Text: the nesting differs by geometry type.
                        T.StructField("coordinates", T.StringType()),
                    ]
                ),
            ),
        ]
    )
    features = _features(spark, path, lines, feature)
    rows = features.select(
        "f.properties.*",
        F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )
    return None if rows.isEmpty() else rows


def geojson_to_table(
    spark: SparkSession,
    source: str,
    name: str,
    properties: T.StructType | None = None,
    lines: bool = False,
    path: str | None = None,
) -> None:
    """Make a new table of a feature collection: its properties, ``geom_type``, ``coordinates``.

    Without ``properties`` the fields are those of the first feature, as in the collection; of
    the others those are taken by name. A collection without features is an error, and so is a
    table that is there already.
    """
    if properties is None:
        properties = _of_first(spark, source, lines)
    rows = read_geojson(spark, source, properties, lines) if properties is not None else None
    if rows is None:
        raise ValueError(f"no features in {source}")
    create_table(rows, name, path)


def _of_first(spark: SparkSession, path: str, lines: bool) -> T.StructType | None:
    """The fields of the first feature's properties; only that feature's text is fetched."""
    one = T.StructType([T.StructField("properties", T.StringType())])
    first = _features(spark, path, lines, one).select("f.properties").where("properties IS NOT NULL").first()
    if first is None:
        return None
    ddl = spark.range(1).select(F.schema_of_json(F.lit(first["properties"]))).first()[0]
    return T.StructType.fromDDL(f"p {ddl}")["p"].dataType


def with_geometry(features: DataFrame, geom_type: str, name: str = "geometry") -> DataFrame:
    """Features of one geometry type, with its coordinates as a nested array column."""
    if geom_type not in _DEPTH:
        raise ValueError(f"unknown geometry type {geom_type!r}")
    return (
        features.where(F.col("geom_type") == geom_type)
        .withColumn(name, geometry_of(F.col("coordinates"), geom_type))
        .drop("geom_type", "coordinates")
    )


def geometry_of(coordinates: Column, geom_type: str) -> Column:
    """Coordinates text to points; null when the text has another nesting."""
    json_type: T.DataType = _PAIR
    for _ in range(_DEPTH[geom_type]):
        json_type = T.ArrayType(json_type)
    return _nested_points(F.from_json(coordinates, json_type), _DEPTH[geom_type])


def _nested_points(value: Column, depth: int) -> Column:
    if depth == 0:
        point = F.struct(F.get(value, F.lit(0)).alias("x"), F.get(value, F.lit(1)).alias("y"))
        return F.when(value.isNotNull(), point)
    return F.transform(value, lambda v: _nested_points(v, depth - 1))


def geometry_type(geom_type: str) -> T.DataType:
    """Column type of a geometry type."""
    return [POINT, LINE, MULTILINE, MULTIPOLYGON][_DEPTH[geom_type]]


def _features(spark, path, lines, feature) -> DataFrame:
    if lines:
        return spark.read.schema(feature).json(path).select(F.struct("*").alias("f"))
    collection = T.StructType([T.StructField("features", T.ArrayType(feature))])
    document = spark.read.schema(collection).json(path, multiLine=True)
    return document.select(F.explode("features").alias("f"))


def _inferred(spark, path, lines) -> T.StructType | None:
    document = spark.read.json(path, multiLine=not lines)
    if lines:
        holder = document.schema
    else:
        if "features" not in document.columns:
            return None
        holder = document.schema["features"].dataType.elementType
    if not isinstance(holder, T.StructType) or "properties" not in holder.names:
        return None
    properties = holder["properties"].dataType
    return properties if isinstance(properties, T.StructType) else None
