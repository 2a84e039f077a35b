"""What the operators of this folder share: reading, words of texts in numpy, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotracks.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts of a batch are taken in slices of about so many bytes, so numpy's tables stay small.
SLICE_BYTES = 1 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(column):
    """``column`` with A-Z, and no other letters, in lower case."""
    return F.translate(column, UPPER, UPPER.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2^64; kept by the process."""
    if _powers.get("up", np.empty(0)).size <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(max(n + 1, SLICE_BYTES + 1), base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Words:
    """The words of some texts, as arrays with one entry for each word, in order.

    ``row``: the text's place among the texts. ``begin``, ``end``: places in ``data``, the
    folded bytes of all texts. ``first``: for each text, and once more at the end, the number
    of words before it. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, inside: np.ndarray, fold: np.ndarray):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        self.data = fold[data[offsets[0] : offsets[-1]]]
        self.starts = offsets - offsets[0]
        word = inside[self.data]
        cut = np.zeros(len(word) + 1, bool)
        cut[self.starts] = True
        before = np.concatenate(([False], word[:-1])) & ~cut[:-1]
        after = np.concatenate((word[1:], [False])) & ~cut[1:]
        self.begin = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.begin, self.starts)
        self.row = np.repeat(np.arange(n), np.diff(self.first))
        self._sums: np.ndarray | None = None

    def hashes(self, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes, or of the bytes from ``begin`` to ``end``."""
        up, down = _power_tables(len(self.data))
        if self._sums is None:
            letters = mix(np.arange(1, 257, dtype=np.uint64))[self.data]
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(letters * up[: len(self.data)], out=self._sums[1:])
        begin = self.begin if begin is None else begin
        end = self.end if end is None else end
        return mix((self._sums[end] - self._sums[begin]) * down[begin])


def folded_ascii() -> np.ndarray:
    """A table of bytes that puts A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about SLICE_BYTES of the column ``text``; no row is cut."""
    if not len(batch):
        return
    sizes = batch[text].cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(sizes.buffers()[1], np.int64, len(batch) + 1, sizes.offset * 8)
    piece = (ends[1:] - ends[0]) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(batch)]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Rounds: each node takes its smallest neighbour as parent if that is smaller, chains of
    parents are shortened by doubling, and edges are carried over to the roots. A round's
    tables are written, so no lineage grows. Only minima are gathered by node, so a node may
    have any number of edges.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialize(
            both.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.least("a", "b").alias("parent")
            )
        )
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            jumped = materialize(
                parents.join(above, "parent").select(
                    "node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")
                )
            )
            parents = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parents.withColumnRenamed("parent", "root")
        else:
            step = parents.select(F.col("node").alias("root"), "parent")
            labels = materialize(
                labels.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
            )
        at = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        to = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = materialize(
            edges.join(at, "a").select("b", "pa").join(to, "b").where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
