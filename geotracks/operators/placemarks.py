"""Features as report placemarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geotracks.functions import geometry as geo
from geotracks.operators.ordering import number_rows

# Texts of the report.
STYLE_URL = "#exampleStyleMap"
NO_POINT = "0,0,0"
TITLE = "<h1>Feature N. {}</h1>"
PROPERTY = (
    '<ul><li><p><font color="green">Property <b>{}</b> has value <b>{}</b></font></p></li></ul>'
)


def placemarks(
    features: DataFrame,
    order_by: Sequence[str],
    axis_order: str = "yx",
    geometry: str = "geometry",
) -> DataFrame:
    """``idx, name, styleUrl, description, coordinates`` of each feature, numbered from 1.

    The description lists every property, the geometry too, in column order. ``axis_order``
    "yx" writes latitude first, "xy" longitude first. A feature whose geometry is no point
    is placed at the origin.
    """
    if axis_order not in ("yx", "xy"):
        raise ValueError("axis_order must be 'yx' or 'xy'")
    numbered = number_rows(features, order_by, name="idx")
    index = F.col("idx").cast("string")
    listed = [
        _fill(PROPERTY, F.lit(name), _text(F.col(name), features.schema[name].dataType))
        for name in features.columns
    ]
    return numbered.select(
        "idx",
        F.concat(F.lit("Feature_"), index).alias("name"),
        F.lit(STYLE_URL).alias("styleUrl"),
        F.concat(_fill(TITLE, index), *listed).alias("description"),
        _coordinates(features, geometry, axis_order).alias("coordinates"),
    )


def _fill(template: str, *values: Column) -> Column:
    """The template with a value at each pair of braces."""
    texts = template.split("{}")
    pairs = [part for text, value in zip(texts, values) for part in (F.lit(text), value)]
    return F.concat(*pairs, F.lit(texts[-1]))


def _coordinates(features: DataFrame, geometry: str, axis_order: str) -> Column:
    if not _is_point(features.schema[geometry].dataType):
        return F.lit(NO_POINT)
    point = F.col(geometry)
    first, second = (1, 0) if axis_order == "yx" else (0, 1)
    text = F.concat_ws(
        ",",
        geo.ordinate(point, first).cast("string"),
        geo.ordinate(point, second).cast("string"),
    )
    located = geo.ordinate(point, 0).isNotNull() & geo.ordinate(point, 1).isNotNull()
    return F.when(located, text).otherwise(F.lit(NO_POINT))


def _text(value: Column, data_type: T.DataType) -> Column:
    if _is_point(data_type):
        shown = F.concat(
            F.lit("POINT ("), value["x"].cast("string"), F.lit(" "), value["y"].cast("string"), F.lit(")")
        )
    elif isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        shown = F.to_json(value)
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit(""))


def _is_point(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and data_type.names == ["x", "y"]
