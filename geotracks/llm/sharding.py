"""Sharding by jump consistent hashing: stable keys, no ring table.

A row's shard follows from its key and the number of shards alone. With one more shard, about
one row in that many moves, and only into the new shard.

Slots number a shard's rows without gaps: rows are counted by shard and input partition, and a
row's slot is the count of its shard before its partition plus its place in it, so no shard is
gathered in one task.

Null keys are one key of their own. Null texts have no bytes. Repeated rows get one shard, and
each its own slot. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotracks.llm.common import mix
from geotracks.session import materialize

#: The key that stands for null.
NULL_KEY = np.uint64(0x6A09E667F3BCC909)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0, of each unsigned 64-bit key."""
    state = keys.astype(np.uint64).copy()
    shard = np.full(len(keys), -1, np.int64)
    ahead = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1
        ahead[live] = np.floor((shard[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.col(text_col).cast("binary")
    sizes = docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["_id"]
            keys = mix(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(_STEP))
            keys = np.where(pc.is_null(ids).to_numpy(zero_copy_only=False), NULL_KEY, keys)
            for name, n in (("shard", shards), ("grown_shard", shards + 1)):
                batch = batch.append_column(name, pa.array(jump(keys, n).astype(np.int32)))
            yield batch

    kind = sizes.schema["_id"].dataType.simpleString()
    placed = sizes.mapInArrow(place, f"_id {kind}, size long, text_crc32 long, shard int, grown_shard int")
    placed = materialize(placed.withColumn("uid", F.monotonically_increasing_id()))
    part = F.shiftright("uid", 33).alias("part")
    counts = placed.groupBy("shard", part).agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy("part")
    before = counts.select("shard", "part", (F.sum("n").over(order) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("uid")) - 1
    return (
        placed.withColumn("part", part).withColumn("inside", inside).join(before, ["shard", "part"])
        .select(
            F.col("_id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("before") + F.col("inside")).cast("long").alias("slot"), "grown_shard",
        )
    )


_STEP = 0x9E3779B97F4A7C15
