"""Boundary tables kept on storage, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geotracks.operators.boundaries import load_boundaries, table_name
from geotracks.sources import tables


def append_boundaries(raw: DataFrame, level: int, base: str) -> DataFrame:
    """Append what fits of ``raw`` to the stored table of a level; returns the rejects.

    The table is made if there is none. Ids are compared with the stored ids alone.
    """
    path = f"{base}/{table_name(level)}"
    stored = read_boundaries(raw.sparkSession, level, base) if tables.layer_exists(raw.sparkSession, path) else None
    accepted, rejected = load_boundaries(raw, level, stored)
    tables.write_layer(accepted, path, "append")
    return rejected


def read_boundaries(spark: SparkSession, level: int, base: str) -> DataFrame:
    """The stored table of a level."""
    return tables.read_layer(spark, f"{base}/{table_name(level)}")
