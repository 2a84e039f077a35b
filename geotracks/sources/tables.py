"""Site CSV, layers opened and written as a whole, and plain table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from geotracks.schemas import SITES
from geotracks.sources import files


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site rows as text, header lines included as rows; see ``operators.sites``."""
    return spark.read.schema(SITES).csv(path, header=False)


def open_layer(
    spark: SparkSession, layers: Sequence[str], name: str | None = None, like: str | None = None
) -> DataFrame:
    """A layer of a data source, given the source's table names.

    A named layer must exist. Without a name the only layer is opened; a source with
    several opens the one called ``like`` (for a target: the source layer's name).
    """
    wanted = name or (layers[0] if len(layers) == 1 else like)
    if wanted is None:
        raise ValueError("the source has more than one layer: name one")
    if wanted not in layers:
        raise ValueError(f"no layer {wanted!r}")
    return spark.table(wanted)


def append_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """``target`` with the rows of ``df`` added; columns by name, missing ones null."""
    here = {c.lower(): c for c in df.columns}
    columns = [
        (F.col(here[f.name.lower()]) if f.name.lower() in here else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in target.schema
    ]
    return target.unionByName(df.select(*columns))


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a layer; readers see all of it or nothing of it.

    The rows go to a folder of their own. Then one row is added to the layer's versions, by one
    rename, and from then on it names the folders that are the layer. A write that fails on the
    way leaves the layer as it was. ``df`` may be read from the layer it replaces. Modes are
    those of Spark's writers. One job writes a layer at a time.
    """
    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    current = _current(spark, path)
    if current and mode == "ignore":
        return
    if current and mode.startswith("error"):
        raise ValueError(f"there is a layer at {path}")
    kept = current["folders"] if current and mode == "append" else []
    if kept and (there := read_layer(spark, path).columns) != df.columns:
        raise ValueError(f"columns {df.columns} cannot be appended to {there}")
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/data/{folder}")
    version = current["version"] + 1 if current else 0
    pointer = spark.range(1, numPartitions=1).select(
        F.lit(version).alias("version"), F.array(*map(F.lit, [*kept, folder])).alias("folders")
    )
    pointer.write.mode("append").parquet(f"{path}/versions")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer as it was last written."""
    current = _current(spark, path)
    if current is None:
        raise ValueError(f"there is no layer at {path}")
    return spark.read.parquet(*[f"{path}/data/{folder}" for folder in current["folders"]])


def layer_exists(spark: SparkSession, path: str) -> bool:
    """True if a layer was written to ``path``."""
    return _current(spark, path) is not None


def vacuum_layer(spark: SparkSession, path: str) -> int:
    """Delete what former versions and failed writes left behind; returns how many folders."""
    current = _current(spark, path)
    live = set(current["folders"]) if current else set()
    old = [folder for folder in files.children(spark, f"{path}/data") if folder not in live]
    for folder in old:
        files.delete(spark, f"{path}/data/{folder}")
    return len(old)


def _current(spark: SparkSession, path: str) -> Row | None:
    try:
        versions = spark.read.schema("version int, folders array<string>").parquet(f"{path}/versions")
    except AnalysisException as error:
        # Any other failure must not pass for a layer that is not there.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return versions.orderBy(F.desc("version")).first()


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Make a new table from a query, with the query's schema; fails if there is one."""
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_view(df: DataFrame, name: str) -> None:
    """Name a query; it runs anew at each use."""
    df.createOrReplaceTempView(name)
