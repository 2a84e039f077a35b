"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors a neighbour graph is built and cut into parts of equal size, by
bisections along the graph's second eigenvector. A small classifier learns the part of a vector.
It puts every vector into its most probable part, and sends a query to its ``probes`` most
probable ones, where all vectors are compared by their exact inner product.

``probes`` is the smallest number with which the sample's own queries find ``RECALL`` of their
true neighbours in the sample. So on data without structure it comes near the number of parts,
and recall holds. Parts are scanned in blocks of ``BLOCK`` vectors and up to ``QUERIES`` queries,
so a part of any size is no long task, and each block returns at most k rows of a query.

Vectors that are null, zero, or hold null or non-finite components take no part, as queries
neither. Vectors of another size than the query's are no candidates. Equal scores are ordered by
id. Rows that repeat an id are vectors of their own, as queries and as candidates; a query never
finds its own row. Rows without an id take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotracks.llm.embeddings import valid_vectors
from geotracks.session import materialize

SAMPLE = 4096
PART_ROWS = 500
MAX_PARTS = 64
NEIGHBOURS = 10
RECALL = 0.94
HIDDEN = 128
BLOCK = 2048
QUERIES = 256


@dataclass
class Router:
    """A classifier of one hidden layer, and the number of parts that a query is sent to."""

    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    offset: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(x @ self.first + self.bias, 0) @ self.second + self.offset


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Each vector's k nearest others, by inner product."""
    near = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for begin in range(0, len(x), 512):
        s = x[begin : begin + 512] @ x.T
        s[np.arange(len(s)), np.arange(begin, begin + len(s))] = -np.inf
        near[begin : begin + 512] = np.argpartition(-s, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    return near


def balanced_parts(near: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """A part, from 0, for each node; sizes differ by a few nodes at most."""
    out = np.zeros(len(near), np.int64)
    draw = np.random.default_rng(seed)

    def cut(nodes: np.ndarray, low: int, n: int) -> None:
        out[nodes] = low
        if n == 1 or len(nodes) < 2:
            return
        place = np.full(len(near), -1)
        place[nodes] = np.arange(len(nodes))
        a = np.repeat(np.arange(len(nodes)), near.shape[1])
        b = place[near[nodes].ravel()]
        a, b = a[b >= 0], b[b >= 0]
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        degree = np.bincount(a, minlength=len(nodes)) + 1.0
        # power steps with the lazy random walk, kept apart from its constant first vector
        v = draw.normal(size=len(nodes))
        for _ in range(60):
            v = (v + (np.bincount(a, weights=v[b], minlength=len(nodes)) + v) / degree) / 2
            v -= (v * degree).sum() / degree.sum()
            v /= np.abs(v).max() + 1e-300
        left = n // 2
        order = np.argsort(v, kind="stable")
        at = len(nodes) * left // n
        cut(nodes[order[:at]], low, left)
        cut(nodes[order[at:]], low + left, n - left)

    cut(np.arange(len(near)), 0, parts)
    return out


def train_router(x: np.ndarray, parts: np.ndarray, n: int, epochs: int = 30, seed: int = 9) -> Router:
    draw = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    weights = [
        draw.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, n)), np.zeros(n)
    ]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for begin in range(0, len(order), 128):
            pick = order[begin : begin + 128]
            hidden = np.maximum(x[pick] @ weights[0] + weights[1], 0)
            z = hidden @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), parts[pick]] -= 1
            p /= len(pick)
            back = (p @ weights[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((x[pick].T @ back, back.sum(axis=0), hidden.T @ p, p.sum(axis=0))):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                weights[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return Router(*weights, probes=n)


def fit(x: np.ndarray, rows: int, k: int, recall: float = RECALL) -> Router:
    """A router from a sample ``x`` of ``rows`` vectors."""
    n = int(min(MAX_PARTS, max(1, rows // PART_ROWS), max(1, len(x) // 32)))
    if n == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    router = train_router(x, balanced_parts(neighbour_graph(x), n), n)
    scores = router.scores(x)
    home = scores.argmax(axis=1)
    asked = np.arange(0, len(x), max(1, len(x) // 512))
    near = neighbour_graph(x, k)[asked]
    order = np.argsort(-scores[asked], axis=1)
    rank = np.argsort(order, axis=1)
    needed = np.take_along_axis(rank, home[near], axis=1)
    found = [(needed < m).mean() for m in range(1, n + 1)]
    router.probes = int(np.argmax(np.array(found) >= recall)) + 1
    return router


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body = [v.tobytes() if v is not None else None for v in valid_vectors(batch["_vector"])]
        yield pa.RecordBatch.from_arrays([batch["_row"], batch["_id"], pa.array(body, pa.binary())], ["_row", "_id", "vec"])


def search(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each row that ``queries`` selects.

    ``queries``: a function from the id's column to a condition.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector"))
    rows = named.mapInArrow(_clean, "_row long, _id long, vec binary").where("vec is not null and _id is not null")
    rows = materialize(rows.withColumn("size", F.octet_length("vec")))
    routers: dict[int, Router] = {}
    # one index for each vector size; a table has one size unless rows are broken
    for size, n in [(r["size"], r["count"]) for r in rows.groupBy("size").count().orderBy(F.desc("count")).limit(8).collect()]:
        share = min(1.0, sample / n)
        # a hash of the row's number picks about ``sample`` vectors, so the driver gets a bounded table
        picked = rows.where((F.col("size") == size) & (F.pmod(F.xxhash64("_row", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30))).toArrow().sort_by("_row")
        if picked.num_rows:
            routers[size] = fit(np.stack([np.frombuffer(v.as_buffer()) for v in picked["vec"]]), n, k)
    shared = spark.sparkContext.broadcast(routers)

    def route(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for size in set(batch["size"].to_pylist()):
                    at = np.flatnonzero(batch["size"].to_numpy() == size)
                    router = shared.value.get(size)
                    if router is None:  # a rare size is one part
                        parts = np.zeros((len(at), 1), np.int64)
                    else:
                        x = np.stack([np.frombuffer(batch["vec"][int(i)].as_buffer()) for i in at])
                        parts = np.argsort(-router.scores(x), axis=1, kind="stable")[:, : router.probes if probing else 1]
                    part = batch.take(pa.array(np.repeat(at, parts.shape[1])))
                    yield part.append_column("part", pa.array(parts.ravel()))

        return run

    schema = "_row long, _id long, vec binary, size int, part long"
    packed = F.collect_list(F.struct("_row", "_id", "vec"))

    def blocks(table: DataFrame, rows_each: int, name: str) -> DataFrame:
        table = materialize(table)
        sizes = table.groupBy("size", "part").agg(F.ceil(F.count("*") / rows_each).alias("_blocks"))
        cut = table.join(sizes, ["size", "part"]).withColumn("_block", F.pmod(F.hash("_row"), "_blocks"))
        return cut.groupBy("size", "part", "_block").agg(packed.alias(name)).drop("_block")

    asked = blocks(rows.where(queries(F.col("_id"))).mapInArrow(route(True), schema), QUERIES, "asked")
    held = blocks(rows.mapInArrow(route(False), schema), BLOCK, "held")
    found = asked.join(held, ["size", "part"]).select("asked", "held").mapInArrow(_nearest(k), "query_row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(id_col), "score")


#: Answers that a task holds before it reduces them to the best of each query.
HELD_ANSWERS = 1 << 19


def _nearest(k: int):
    """The k best of each query among all blocks that a task meets, so few rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for asked, held in zip(batch["asked"], batch["held"]):
                (rows, q, x), (others, ids, y) = _block(asked), _block(held)
                scores = x @ y.T
                scores[rows[:, None] == others[None]] = -np.inf
                n = min(k, len(ids))
                # all that reach the k-th score, so ties go to the smaller id
                limit = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
                i, j = np.nonzero((scores >= limit[:, None]) & np.isfinite(scores))
                kept.append(_best([(rows[i], q[i], ids[j], scores[i, j])], k))
                if sum(len(x[0]) for x in kept) >= HELD_ANSWERS:
                    kept = [_best(kept, k)]
                    # as many queries as fill half of it go out; the window takes the rest
                    if len(kept[0][0]) >= HELD_ANSWERS // 2:
                        yield _answers(kept.pop())
        if kept:
            yield _answers(_best(kept, k))

    return run


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of (query rows, query ids, ids, scores) the k best of each query's row."""
    rows, q, ids, scores = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, -scores, rows))
    rows, q, ids, scores = rows[order], q[order], ids[order], scores[order]
    top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[top], q[top], ids[top], scores[top]


def _answers(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_row", "query_id", "vec_id", "score"])


def _block(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    held = rows.values
    return held.field("_row").to_numpy(), held.field("_id").to_numpy(), np.stack([np.frombuffer(v.as_buffer()) for v in held.field("vec")])
