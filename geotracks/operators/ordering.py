"""Ordered work (numbering, previous row, row by position) that no key or task has to hold.

Spark's own range exchange puts the rows in order, and they are stored so. A partition holds
one range of the order, whatever its size, and one small table, with a row for each partition,
says what lies before it. A hot key spans as many partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from geotracks.session import materialize

#: ``_at`` is a partition's number above these bits, and a row's number in it below.
_BITS = 33


def _in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` stored in the order of ``columns``, with ``_at``, ``_part`` and ``_inside``.

    Spark samples the rows before it exchanges them, so ``df`` is evaluated twice: store it
    first where it is costly.
    """
    return stored_in_place(df.repartitionByRange(*columns).sortWithinPartitions(*columns))


def stored_in_place(df: DataFrame) -> DataFrame:
    """``df`` stored as it lies in its partitions, with ``_at``, and ``_part`` and ``_inside`` from 0."""
    stored = materialize(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _BITS)
    return stored.withColumns({"_part": part, "_inside": F.col("_at") - F.shiftleft(part, _BITS)})


def rows_before(parts: DataFrame) -> DataFrame:
    """For each partition how many rows lie before it, and how many there are in all."""
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition.
    so_far = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return materialize(
        counts.select(
            "_part",
            "_rows",
            F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before"),
            F.sum("_rows").over(every).alias("_all"),
        )
    )


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    name: str = "ordinal",
    total: str | None = None,
) -> DataFrame:
    """Dense 1-based position in ``order_by`` within each ``by`` group, and group size.

    ``order_by`` must be unique within a group.
    """
    ordered = _in_order(df, [*by, *order_by])
    placed = ordered.join(rows_before(ordered), "_part").withColumn(
        "_place", F.col("_before") + F.col("_inside")
    )
    if not by:
        return placed.select(
            *df.columns,
            (F.col("_place") + 1).alias(name),
            *([F.col("_all").alias(total)] if total else []),
        )
    # A struct is never null, so groups with null keys join by plain equality.
    placed = placed.withColumn("_group", F.struct(*by))
    starts = placed.groupBy("_group").agg(
        F.min("_place").alias("_start"), F.count("*").alias("_total")
    )
    return placed.join(materialize(starts), "_group").select(
        *df.columns,
        (F.col("_place") - F.col("_start") + 1).alias(name),
        *([F.col("_total").alias(total)] if total else []),
    )


def with_previous(
    df: DataFrame,
    value: Column,
    order_by: Sequence[str],
    by: Sequence[str],
    name: str = "previous",
) -> DataFrame:
    """``value`` of the row before, in ``order_by`` within ``by``; null on the first row."""
    keyed = df.withColumn("_held", F.struct(F.struct(*by).alias("group"), value.alias("value")))
    ordered = _in_order(keyed, [*by, *order_by])
    inside = Window.partitionBy("_part").orderBy("_at")
    last = ordered.groupBy("_part").agg(F.max_by("_held", "_at").alias("_last"))
    # One row per partition.
    carried = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_carried"))
    walked = ordered.withColumn("_above", F.lag("_held").over(inside)).join(materialize(carried), "_part")
    above = F.when(F.col("_inside") == 0, F.col("_carried")).otherwise(F.col("_above"))
    return walked.withColumn("_above", above).select(
        *df.columns,
        F.when(F.col("_above.group") == F.col("_held.group"), F.col("_above.value")).alias(name),
    )


def assign_fid(
    df: DataFrame, order_by: Sequence[str], start: int | Column = 0, name: str = "fid"
) -> DataFrame:
    """Surrogate ids ``start + 1, start + 2, ...`` in ``order_by`` order."""
    numbered = number_rows(df, order_by, name="_ordinal")
    offset = start if isinstance(start, Column) else F.lit(start)
    return numbered.select(
        (F.coalesce(offset, F.lit(0)) + F.col("_ordinal")).cast("long").alias(name),
        *[c for c in df.columns if c != name],
    )


def feature_at(df: DataFrame, order_by: Sequence[str], index: int) -> DataFrame:
    """The row at a 0-based position, or no row when the layer is shorter.

    Only the keys are exchanged, by ranges, and counted. The range that holds the position is
    the only one to be sorted, and the row is then read by its key. ``order_by`` must be unique.
    """
    if index < 0:
        raise ValueError("index must not be negative")
    keys = df.select(*order_by).repartitionByRange(*order_by)
    ranged = materialize(keys.withColumn("_part", F.spark_partition_id()))
    # One row comes to the driver, and then one key.
    held = rows_before(ranged).where((F.col("_before") <= index) & (F.col("_before") + F.col("_rows") > index)).first()
    if held is None:
        return df.limit(0)
    inside = ranged.where(F.col("_part") == held["_part"]).select(*order_by)
    key = inside.orderBy(*order_by).offset(index - held["_before"]).first()
    same = [F.col(c).eqNullSafe(F.lit(key[c]).cast(df.schema[c].dataType)) for c in order_by]
    return df.where(reduce(and_, same))




def first_features(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order."""
    return df.orderBy(*order_by).limit(n)
