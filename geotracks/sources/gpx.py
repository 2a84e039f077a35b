"""GPX files as track vertices."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from geotracks.session import materialize

_POINT = T.StructType(
    [T.StructField("_lat", T.DoubleType()), T.StructField("_lon", T.DoubleType())]
)
_CORRUPT = "_corrupt_record"
_TRACK = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "trkseg",
            T.ArrayType(T.StructType([T.StructField("trkpt", T.ArrayType(_POINT))])),
        ),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)
_OPTIONS = {
    "rowTag": "trk",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "ignoreSurroundingSpaces": "false",
}


def read_gpx(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, rejects) of every ``*.gpx`` file matched by ``path``.

    A file that cannot be read to its end gives no vertex at all and one row in rejects.
    Files are parsed where they are read, one task per file at most.
    """
    raw = spark.read.format("xml").schema(_TRACK).options(**_OPTIONS).load(path)
    return split_gpx(store_rows(_with_file(raw)), file_ends(spark, path))


def file_ends(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(src, ended) of files: whether the root element is closed. Rows are read tag by tag."""
    tags = spark.read.option("lineSep", ">").text(paths)
    last = F.col("value").rlike(r"</gpx\s*$|<gpx\b[^<]*/$")
    return _with_file(tags).groupBy("src").agg(F.max(last).alias("ended"))


def literal_path(src: str) -> str:
    """A file's address as a path to read, without pattern characters."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(src))


def stream_gpx_rows(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming rows of the GPX files that arrive in a folder, for ``split_gpx``."""
    stream = spark.readStream.format("xml").schema(_TRACK).options(**_OPTIONS)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return _with_file(stream.option("pathGlobFilter", "*.gpx").load(folder))


def _with_file(raw: DataFrame) -> DataFrame:
    """Adds the file path, by which files are ordered."""
    return raw.select("*", F.col("_metadata.file_path").alias("src"))


def store_rows(raw: DataFrame) -> DataFrame:
    """Parsed rows, numbered in file order and stored, so that files are parsed once.

    Rows of one file are read in order by one task, so the number follows the file.
    """
    return materialize(raw.withColumn("ogc_fid", F.monotonically_increasing_id() + 1))


def split_gpx(raw: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices of whole files, and the names of broken ones, from stored rows.

    ``ends`` tells which files are closed: a file cut between two tracks has no corrupt row.
    """
    unread = raw.where(F.col(_CORRUPT).isNotNull()).select("src")
    broken = materialize(
        unread.unionByName(ends.where("NOT ended").select("src")).groupBy("src").agg(
            F.lit("file cannot be read").alias("reason")
        )
    )
    tracks = (
        raw.where(F.col(_CORRUPT).isNull())
        .join(broken.select("src"), "src", "left_anti")
    )
    segments = F.filter(
        F.transform("trkseg", lambda s: s["trkpt"]), lambda pts: F.size(pts) > 0
    )
    parts = tracks.select("src", "ogc_fid", "name", F.posexplode(segments).alias("seg_no", "pts"))
    vertices = parts.select(
        "src", "ogc_fid", "name", "seg_no", F.posexplode("pts").alias("_pos", "pt")
    ).select(
        "src",
        "ogc_fid",
        "name",
        "seg_no",
        (F.col("_pos") + 1).cast("long").alias("pt_no"),
        F.col("pt._lon").alias("x"),
        F.col("pt._lat").alias("y"),
    )
    return vertices, broken
