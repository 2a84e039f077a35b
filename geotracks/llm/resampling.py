"""Importance resampling towards a target's words, ranked by parallel sorting by regular sampling.

Features are runs of consecutive words, hashed to buckets. The buckets of every document are made
once and stored; their counts over all documents and over the target give each bucket's gain, an
array by which all documents are scored. A draw from a hash of the id is added, so the highest
scores are a random sample weighted towards the target.

Ranks: every stored partition is sorted where it lies, a run. Rows at regular places of the runs,
``SAMPLES`` or more for each segment, are sorted on the driver, and regular ones of them are splitters.
Rows go to the segment that the splitters give, each segment is merged by one sort, and counts of
the segments before it make places into ranks. There is a segment for each shuffle partition of
the session, and for each ``SEGMENT_ROWS`` rows if those are more; the driver and a task thus hold
some ``SAMPLES`` keys of a few dozen bytes for a million documents.

Null and empty texts have no features and weight 0. A null id is hashed as an empty one and comes
last among equal scores. Rows that repeat an id are scored each on its own; of equal rows any may
come first, and their number in the table parts them between segments. Very long texts are read a
slice at a time, and only their buckets are kept. Empty tables give no rows, or gains from the
other table alone. Only the id and the text of the tables are read.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotracks.llm.common import Words, folded_ascii, slices
from geotracks.operators.ordering import rows_before, stored_in_place
from geotracks.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_ROWS, SAMPLES = 1_000_000, 8
#: Longer features are hashed one by one.
SHORT = 48


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, longest: int = 1, percent: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of all ``docs``; rank is null for those not drawn.

    Of the N documents with ``least_words`` words, N * ``percent`` // 100 are drawn.
    """
    made = materialize(featured(docs.select(F.col(id_col).alias("_id"), text_col), text_col, buckets, longest))
    aim = featured(target.select(F.lit(None).cast("long").alias("_id"), text_col), text_col, buckets, longest)
    gain = gains(tally(made, buckets), tally(aim, buckets))
    kind = made.schema["_id"].dataType.simpleString()
    weighed = made.mapInArrow(_weigh(gain), f"_id {kind}, n_words long, n_features long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    drawn = (F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000.0 * F.log(-F.log(drawn))))
    ranked = by_rank(scored, F.col("n_words") >= least_words)
    take = F.expr(f"_all * {percent} div 100")
    rank = F.when(F.col("rank") <= take, F.col("rank"))
    return ranked.select(F.col("_id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))


# --- features and gains -------------------------------------------------------------------


def featured(rows: DataFrame, text_col: str, buckets: int, longest: int) -> DataFrame:
    """(_id, n_words, n_features, _buckets): each text's buckets, as the bytes of their numbers."""
    wide = _width(buckets)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.zeros(256, bool)
        inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = True
        for batch in batches:
            for piece in slices(batch, text_col):
                words = Words(piece[text_col], inside, folded_ascii())
                n_words = np.diff(words.first)
                values, first = _features(words, buckets, longest)
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(piece), [None, pa.py_buffer(first * wide.itemsize), pa.py_buffer(values.astype(wide))]
                )
                yield pa.RecordBatch.from_arrays(
                    [piece["_id"], pa.array(n_words, pa.int64()), pa.array(np.diff(first), pa.int64()), held.cast(pa.binary())],
                    ["_id", "n_words", "n_features", "_buckets"],
                )

    return rows.mapInArrow(run, f"_id {kind}, n_words long, n_features long, _buckets binary")


def _width(buckets: int) -> np.dtype:
    return np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)


def _features(words: Words, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of up to ``longest`` words, text by text; where each text's begin."""
    size = words.end - words.begin
    # the words again, with one space behind each
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    data = np.full(begin[-1], 0x20, np.uint8)
    at = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    data[at] = words.data[np.arange(size.sum()) + np.repeat(words.begin - (np.cumsum(size) - size), size)]
    begin, end = begin[:-1], begin[:-1] + size
    rows, values = [], []
    for more in range(longest):
        n = max(0, len(size) - more)
        whole = words.row[:n] == words.row[more:]
        rows.append(words.row[:n][whole])
        values.append(crc32(data, begin[:n][whole], end[more:][whole]) % np.uint32(buckets))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(row, kind="stable")
    return value[order], np.searchsorted(row[order], np.arange(len(words.first))).astype(np.int64)


def crc32(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of ``data``: all short ones byte by byte together."""
    size = end - begin
    out = np.empty(len(size), np.uint32)
    for i in np.flatnonzero(size > SHORT):
        out[i] = zlib.crc32(data[begin[i] : end[i]])
    short = np.flatnonzero(size <= SHORT)
    order = short[np.argsort(-size[short], kind="stable")]
    lengths, at = size[order], begin[order]
    now = np.full(len(order), 0xFFFFFFFF, np.uint32)
    table = _crc_table()
    for n in range(lengths.max(initial=0)):
        left = np.searchsorted(-lengths, -n, "left")
        now[:left] = table[(now[:left] ^ data[at[:left] + n]) & np.uint32(0xFF)] ^ (now[:left] >> np.uint32(8))
    out[order] = ~now
    return out


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


def tally(made: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket. A task sums its rows; ``buckets`` sums come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch, _width(buckets)), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["bucket", "n"])

    sums = made.select("_buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def _numbers(batch: pa.RecordBatch, wide: np.dtype) -> np.ndarray:
    held = batch["_buckets"].cast(pa.large_binary())
    ends = np.frombuffer(held.buffers()[1], np.int64, len(held) + 1, held.offset * 8)
    if not len(held) or ends[0] == ends[-1]:
        return np.empty(0, wide)
    return np.frombuffer(held.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(wide)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: the logarithm, in thousandths, of its share in the target against the source."""
    n, all_source, all_target = len(source), float(source.sum() + len(source)), float(target.sum() + len(source))
    return np.array(
        [floor(1000 * log((float(target[b]) + 1) * all_source / ((float(source[b]) + 1) * all_target))) for b in range(n)], np.int64
    )


def _weigh(gain: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["n_features"].to_numpy()
            sums = np.concatenate(([0], np.cumsum(gain[_numbers(batch, _width(len(gain)))])))
            ends = np.cumsum(sizes)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["n_words"], batch["n_features"], pa.array(weight, pa.int64())], ["_id", "n_words", "n_features", "weight"]
            )

    return run


# --- ranks --------------------------------------------------------------------------------


def by_rank(scored: DataFrame, drawable) -> DataFrame:
    """``scored`` with ``rank`` of its ``drawable`` rows, from the highest score; ``_all`` counts those."""
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("n_features"), F.asc("_tie")]
    keyed = scored.withColumns({"_out": ~drawable, "_tie": F.monotonically_increasing_id()})
    runs = stored_in_place(keyed.sortWithinPartitions("_out", *order))
    inside = runs.where("not _out")
    before = rows_before(inside)
    rows = before.agg(F.max("_all")).first()[0] or 0
    segments = max(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SEGMENT_ROWS))
    keys = ["score", "_id", "n_features", "_tie"]
    every = max(1, rows // (segments * SAMPLES))
    sampled = inside.join(before, "_part").where((F.col("_before") + F.col("_inside")) % every == 0)
    samples = sampled.select(*keys).toArrow().sort_by([(c, "descending" if c == "score" else "ascending") for c in keys])
    at = [samples.num_rows * n // segments for n in range(1, segments) if samples.num_rows]
    splitters = samples.take(pa.array(at, pa.int64())).combine_chunks()
    columns = [*keys, "weight"]
    dealt = inside.select(*columns).mapInArrow(_deal(splitters), _schema(inside, columns) + ", _segment int")
    merged = stored_in_place(dealt.repartitionById(segments, "_segment").sortWithinPartitions("_segment", *order))
    placed = merged.join(rows_before(merged), "_part")
    ranked = placed.select("_id", "n_features", "weight", "score", (F.col("_before") + F.col("_inside") + 1).alias("rank"), "_all")
    none = F.lit(None).cast("long")
    return ranked.unionByName(runs.where("_out").select("_id", "n_features", "weight", "score", none.alias("rank"), none.alias("_all")))


def _schema(table: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in columns)


def _deal(splitters: pa.Table) -> Callable:
    """Adds the number of splitters at or before each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            both = {c: pa.chunked_array([batch[c], *splitters[c].chunks]).combine_chunks() for c in splitters.column_names}
            names = pc.rank(both["_id"], "ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
            split = np.arange(len(names)) >= rows
            order = np.lexsort((~split, both["_tie"].to_numpy(), both["n_features"].to_numpy(), names, -both["score"].to_numpy()))
            passed = np.empty(len(names), np.int32)
            passed[order] = np.cumsum(split[order])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(passed[:rows])], [*batch.schema.names, "_segment"])

    return run
