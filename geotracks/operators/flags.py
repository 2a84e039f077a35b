"""Marking listed features with a class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# The survey's excluded plots, in the order they were listed.
EXCLUDED_PLOTS = [
    "SAK-1-4-1-1", "SAK-1-4-1-4", "SAK-1-4-1-5", "SAK-1-4-1-6", "SAK-1-4-1-7", "SAK-1-4-1-8",
    "SAK-1-4-1-9", "SAK-1-4-1-10", "SAK-1-4-1-13", "SAK-1-6-1-1", "SAK-1-6-1-2", "SAK-1-6-1-3",
    "SAK-1-6-1-4", "SAK-1-6-1-5", "SAK-2-1-1-1", "SAK-1-8-2-4", "SAK-1-8-2-6", "SAK-3-2-2-4",
    "SAK-1-7-5-0", "NEG-1-1-2-2", "OUA-2-6-1-8", "OUA-2-6-1-19", "OUA-2-3-1-5", "OUA-2-3-1-7",
    "MAD-4-1-4-0", "INA-3-6-2-4", "INA-2-5-3-0", "INA-3-4-3-2", "INA-3-4-3-3", "INA-3-6-2-3",
    "SAN-2-6-2-2", "SEK-4-6-3-1", "SEK-4-6-3-2", "SEK-4-6-3-3", "SEK-4-6-3-4", "SEK-4-6-3-5",
    "SEK-4-6-3-6", "SEK-3-1-3-1", "SOR-1-1-1-1", "SOR-1-1-1-2", "SOR-1-1-1-3", "SOR-1-1-1-4",
    "SOR-1-1-1-5", "SOR-1-1-1-6", "SOR-1-1-1-7", "TOU-2-3-2-2", "TOU-2-6-3-0", "BIR-2-8-2-0",
    "PIA-3-1-1-4", "PIA-2-3-6-1", "PIA-2-3-6-5", "PIA-2-1-1-1", "INA-3-3-8-0", "PIA-2-3-6-7",
    "BEN-3-1-1-6",
]

# The survey's excluded areas, in the order they were listed, with repeats.
EXCLUDED_AREAS = [
    "MAR-1-3-5", "SEK-4-5-6", "GOR-2-7-1", "GOR-4-2-1", "GOR-4-2-2", "GOR-4-2-3", "GOR-4-2-4",
    "GOR-4-2-5", "GOR-4-2-6", "GOR-4-2-7", "GOR-2-4-2", "GOR-4-2-1", "GOR-4-2-2", "GOR-4-2-2",
    "GOR-4-2-3", "GOR-4-2-4", "GOR-4-2-5", "GOR-4-2-6", "GOR-4-2-6", "GOR-4-2-7", "INA-2-1-5",
    "MAD-4-1-4", "MAR-3-5-2", "SAK-2-1-1", "SAN-2-6-2", "SOR-1-1-1", "BIR-2-8-2", "PIA-3-1-1",
]


def flag(df: DataFrame, ids: DataFrame | Sequence[str], key: str, clazz: int = 1) -> DataFrame:
    """Sets ``clazz`` where ``key`` is listed; other rows keep theirs.

    A Python list becomes an IN list inside the scan stage. A table of ids (first column)
    is joined; repeats in it do not multiply rows.
    """
    if not isinstance(ids, DataFrame):
        listed = F.coalesce(F.col(key).isin(list(dict.fromkeys(ids))), F.lit(False))
        return df.withColumn("clazz", F.when(listed, clazz).otherwise(F.col("clazz")))
    hits = ids.select(F.col(ids.columns[0]).alias(key)).distinct().withColumn("_hit", F.lit(True))
    return df.join(hits, key, "left").select(
        *[
            F.when(F.col("_hit"), clazz).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c == "clazz"
            else F.col(c)
            for c in df.columns
        ]
    )
