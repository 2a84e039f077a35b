"""KML report documents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from geotracks.sources import files

# Header of the report document.
ROOT = 'kml xmlns="http://earth.google.com/kml/2.0"'
FOLDER_NAME = "NAME"
FOLDER_DESCRIPTION = "DESC"
STYLE_MAP = "exampleStyleMap"
STYLES = {
    "highlight": (
        "highlightPlacemark",
        "http://maps.google.com/mapfiles/kml/paddle/red-stars.png",
    ),
    "normal": (
        "normalPlacemark",
        "http://maps.google.com/mapfiles/kml/paddle/wht-blank.png",
    ),
}

#: Columns of a placemark that are written; the last one belongs to its point.
_TEXTS = ("name", "styleUrl", "description", "coordinates")
#: What a text holds if it takes more than escaping of two characters, and how long others may be.
NOT_PLAIN = r"[^\x20-\x7E]|[\]<&]>|^>"
PLAIN_LENGTH = 900


def report_lines(placemarks: DataFrame) -> DataFrame:
    """``place, line``: the lines of the report document, in order of ``place``.

    One header, a placemark each, one footer; all placemarks are in one folder element.
    """
    return _document(placemarks).select("place", _line().alias("line"))


def _document(placemarks: DataFrame) -> DataFrame:
    """What the lines are made of: ``place``, a placemark's texts, or the text ``end``."""
    ends = placemarks.sparkSession.createDataFrame(
        [(0, _header()), (None, f"</Folder>\n</{ROOT.split()[0]}>")], "place long, end string"
    )
    marks = placemarks.select(F.col("idx").alias("place"), *_TEXTS)
    return marks.unionByName(ends, allowMissingColumns=True)


def _line() -> Column:
    placemark = F.struct(*_TEXTS[:-1], F.struct(_TEXTS[-1]).alias("Point"))
    # A placemark is one line: breaks between its elements go, those in its texts are escaped.
    xml = F.regexp_replace(F.to_xml(placemark, {"rowTag": "Placemark"}), r">\s*\n\s*<", "><")
    odd = F.regexp_replace(F.regexp_replace(xml, "\r", "&#13;"), "\n", "&#10;")
    # Printable ASCII needs no more than this, and most reports hold nothing else.
    short = [F.coalesce(F.length(c) <= PLAIN_LENGTH, F.lit(False)) for c in _TEXTS]
    plain = reduce(and_, [*short, *[~F.rlike(c, F.lit(NOT_PLAIN)) for c in _TEXTS]])
    shown = [
        F.concat(F.lit(f"<{c}>"), F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(f"</{c}>"))
        for c in _TEXTS
    ]
    text = F.concat(F.lit("<Placemark>"), *shown[:-1], F.lit("<Point>"), shown[-1], F.lit("</Point></Placemark>"))
    return F.when(F.col("end").isNotNull(), F.col("end")).when(plain, text).otherwise(odd)


def _header() -> str:
    styles = "".join(
        f'<Style id="{style}"><IconStyle><Icon><href>{href}</href></Icon></IconStyle></Style>\n'
        for style, href in STYLES.values()
    )
    pairs = "".join(
        f"<Pair><key>{key}</key><styleUrl>#{STYLES[key][0]}</styleUrl></Pair>" for key in ("normal", "highlight")
    )
    return (
        f"<{ROOT}>\n<Folder>\n<name>{FOLDER_NAME}</name>\n<description>{FOLDER_DESCRIPTION}</description>\n"
        f'{styles}<StyleMap id="{STYLE_MAP}">{pairs}</StyleMap>'
    )


def write_kml(placemarks: DataFrame, path: str, join: bool = False) -> None:
    """Write one report document, as the part files of a folder.

    The parts are ranges of the document, in the order of their names: only the first begins
    with the header, only the last ends with the footer, and each is written by a task of its
    own. ``join`` makes one file of them (see ``files.join``).
    """
    ordered = _in_order(placemarks)
    if not join:
        ordered.write.mode("overwrite").text(path)
        return
    parts = f"{path}.parts"
    ordered.write.mode("overwrite").text(parts)
    files.join(placemarks.sparkSession, parts, path)


def _in_order(placemarks: DataFrame) -> DataFrame:
    """The lines, exchanged by ranges of the document.

    The exchange reads its rows twice, to find the ranges; lines are made behind it, once.
    """
    order = F.asc_nulls_last("place")
    rows = _document(placemarks).repartitionByRange(order).sortWithinPartitions(order)
    return rows.select(_line().alias("line"))


def read_kml(spark: SparkSession, path: str) -> DataFrame:
    """The placemarks of a report document by ``write_kml``, joined or not, without their numbers."""
    fields = "name string, styleUrl string, description string, Point struct<coordinates:string>"
    lines = spark.read.text(path).where(F.startswith("value", F.lit("<Placemark>")))
    marks = lines.select(F.from_xml("value", fields).alias("m"))
    return marks.select("m.name", "m.styleUrl", "m.description", F.col("m.Point.coordinates").alias("coordinates"))
