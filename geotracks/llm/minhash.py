"""Near-duplicates by bottom-k sketches from one hash function.

A text's set is its distinct five-word shingles; fewer words are one shingle, no words an empty
set, which is linked with nothing. Shingles are compared by 64-bit hashes.

1. Texts of equal sets are one class. All that follows works on classes.
2. A sketch is the ``K`` smallest hashes of a set. Of two sets at ``THRESHOLD`` or more, each
   element of the union's K smallest hashes lies in both sketches with that probability, so they
   share fewer than ``SHARED`` values about once in 100,000 pairs at the threshold itself, and
   far less often above it. Sets of at most THRESHOLD * K hashes are exact.
3. Inverted lists: a sketch's values are ordered by how many classes hold them. Two sketches with
   c values in common also share one of their K - c + 1 rarest, so only those are listed. Values
   that only one class holds, and common passages beyond those, are in no list.
4. Each list's members are paired with its smallest member. Pairs whose union sketch estimates
   too low a similarity go, and full sets decide. Links give components.
5. In lists that still hold several components, members are compared in blocks by sketches.
   What comes out is members, not pairs: those with a likely partner in another component, in
   the first list that both are in. These are compared in blocks by their full sets, and of the
   links between two components one comes out. So a large group of near copies is never
   expanded into its pairs.

Null texts have no words. Repeated rows are of one class. Null ids are no component's smallest
unless all are null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotracks.llm.common import Words, components, folded_ascii, mix, slices
from geotracks.session import materialize

WIDTH = 5
THRESHOLD = 0.75
K = 32
SHARED = 12
#: Members of a list that are compared with one another at a time.
BLOCK = 256

_INSIDE = np.ones(256, bool)
_INSIDE[[32, *range(9, 14)]] = False
_FOLD = folded_ascii()
_FACTORS = mix(np.arange(101, 101 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted hashes, as positive 63-bit values, of each text's set."""
    words = Words(texts, _INSIDE, _FOLD)
    h = words.hashes()
    full = np.zeros(max(0, len(h) - WIDTH + 1), np.uint64)
    for i in range(WIDTH):
        full += h[i : i + len(full)] * _FACTORS[i]
    full = (mix(full) >> np.uint64(1)).view(np.int64)
    for a, b in zip(words.first, words.first[1:]):
        n = b - a
        if n >= WIDTH:
            yield np.unique(full[a : b - WIDTH + 1])
        elif n:
            short = (h[a:b] * _FACTORS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
            yield (mix(short) >> np.uint64(1)).view(np.int64)
        else:
            yield np.empty(0, np.int64)


def _signatures(keep: list[str], whole: bool):
    """Columns ``keep``, the set's size, its fingerprint, and its sketch or all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                sets = list(shingle_sets(piece["_text"]))
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                if whole:
                    values = pa.array([s.tobytes() for s in sets], pa.binary())
                else:
                    values = pa.array([s[:K] for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(piece[c] for c in keep), sizes, pa.array(prints, pa.binary()), values], [*keep, "n", "print", "values"]
                )

    return run


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print, n_shingles, component_id, kept) of every row of ``docs``.

    ``print`` is the fingerprint of the row's set; null for an empty one. ``kept``: the row has
    its component's smallest id.
    """
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = named.schema["_id"].dataType.simpleString()
    signed = materialize(named.mapInArrow(_signatures(["_id"], False), f"_id {kind}, n long, print binary, values array<long>"))
    classes = (
        signed.where("n > 0").groupBy("print").agg(F.min("_id").alias("_id"), F.min("n").alias("n"), F.first("values").alias("values"))
    )
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()))
    links = _links(named, classes)
    roots = classes.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").select(
        "print", "_id", F.coalesce("root", "cls").alias("root")
    )
    roots = materialize(roots)
    least = roots.groupBy("root").agg(F.min("_id").alias("component_id"))
    found = roots.join(least, "root").select("print", "component_id")
    return signed.select("_id", "print", "n").join(found, "print", "left").select(
        F.col("_id").alias(id_col), "print", F.col("n").alias("n_shingles"),
        F.when(F.col("print").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _links(named: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) linked classes that connect every component; not all pairs within one."""
    lists = materialize(_lists(classes))
    least = lists.groupBy("value").agg(F.min("cls").alias("a"))
    stars = lists.join(least, "value").where("a <> cls").select("a", F.col("cls").alias("b")).distinct()
    sets = _full_sets(named, classes, lists.select("cls").distinct())
    links = materialize(_verified(_likely(stars, classes), sets))
    roots = components(links)

    held = lists.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("value", "cls", "at", F.coalesce("root", "cls").alias("root"))
    mixed = held.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("value")
    listed = lists.groupBy("cls").agg(F.sum(F.expr("shiftleft(1L, at)")).alias("listed"))
    held = materialize(held.join(mixed, "value").select("value", "cls", "root"))
    near = materialize(_pairs_of_blocks(held, classes.select("cls", "n", "values").join(listed, "cls"), _partners, "value long, cls long").distinct())
    again = near.join(held, ["value", "cls"])
    return links.unionByName(_pairs_of_blocks(again, sets, _linked, "a long, b long"))


def _pairs_of_blocks(held: DataFrame, classes: DataFrame, test, schema: str) -> DataFrame:
    """``test`` on every two blocks, and each with itself, of each list's members.

    ``held``: (value, cls, root). A list is cut in blocks of about BLOCK members.
    """
    sizes = held.groupBy("value").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = held.join(sizes, "value").join(classes, "cls")
    chunk = F.pmod(F.hash("cls"), "blocks").cast("int")
    rest = [c for c in classes.columns if c != "cls"]
    blocks = rows.groupBy("value", chunk.alias("chunk")).agg(F.collect_list(F.struct("cls", "root", *rest)).alias("members"))
    other = blocks.select("value", F.col("chunk").alias("chunk_b"), F.col("members").alias("members_b"))
    return blocks.join(other, "value").where("chunk <= chunk_b").select("value", "members", "members_b").mapInArrow(test, schema)


def _lists(classes: DataFrame) -> DataFrame:
    """(value, cls, at): the rarest values of each sketch that others hold too, and their places."""
    postings = classes.select("cls", F.size("values").alias("s"), "n", F.posexplode("values").alias("at", "value"))
    counts = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    small = F.col("n") <= THRESHOLD * K
    need = F.when(small, F.ceil(THRESHOLD * F.col("n"))).otherwise(F.lit(SHARED))
    ranked = postings.join(counts, "value").withColumn("place", F.row_number().over(Window.partitionBy("cls").orderBy("df", "value")))
    common = F.count("*").over(Window.partitionBy("cls"))
    # the values that no other class holds come first in the order
    ranked = ranked.withColumn("own", F.col("s") - common)
    return ranked.where(F.col("own") + F.col("place") <= F.col("s") - need + 1).select("value", "cls", "at")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose union sketch does not rule them out."""
    of = classes.select("cls", "n", "values")
    a = of.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("values").alias("v_a"))
    b = of.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("values").alias("v_b"))
    near = pairs.join(a, "a").join(b, "b").where(F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
    union = F.slice(F.array_sort(F.array_union("v_a", "v_b")), 1, K)
    shared = F.size(F.array_intersect(F.array_intersect("v_a", "v_b"), union))
    return near.where(shared >= SHARED * F.size(union) / K).select("a", "b")


def _full_sets(named: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, set) of the classes ``wanted``, read from one row of each."""
    ids = classes.join(wanted, "cls").select("cls", "print", "_id")
    rows = named.join(ids.select(F.col("_id").alias("_wanted")).distinct(), F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi")
    kind = named.schema["_id"].dataType.simpleString()
    sets = rows.mapInArrow(_signatures(["_id"], True), f"_id {kind}, n long, print binary, values binary")
    # a class's row is told by its id and fingerprint; a repeated row gives the same set
    found = sets.join(ids.select("print", "cls", F.col("_id").alias("_wanted")), "print").where(F.col("_id").eqNullSafe(F.col("_wanted")))
    return materialize(found.select("cls", F.col("values").alias("set")).dropDuplicates(["cls"]))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b").mapInArrow(_exact, "a long, b long")


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["set_a"], batch["set_b"]):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(shared >= THRESHOLD * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class _Incidence:
    """Which members of two blocks hold which values; only values that several hold count."""

    def __init__(self, left: list[np.ndarray], right: list[np.ndarray]):
        rows = [*left, *right]
        row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        pool, inverse, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
        several = counts > 1
        keep = several[inverse]
        self.pool = pool[several]
        self.row, self.column = row[keep], (np.cumsum(several) - 1)[inverse[keep]]

    def shared(self, a: int, b: int) -> np.ndarray:
        """How many values each of the left members shares with each of the right ones."""
        out = np.zeros((a, b), np.float32)
        step = 4096  # columns at a time, so the table stays small
        for begin in range(0, len(self.pool), step):
            at = (self.column >= begin) & (self.column < begin + step)
            part = np.zeros((a + b, step), np.float32)
            part[self.row[at], self.column[at] - begin] = 1
            out += part[:a] @ part[a:].T
        return out


def _block(members: pa.ListScalar) -> dict[str, np.ndarray]:
    held = members.values
    return {c: held.field(c) if c in ("values", "set") else held.field(c).to_numpy() for c in (f.name for f in held.type)}


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members with a likely partner in another component, in the first list of both."""
    for batch in batches:
        for value, left, right in zip(batch["value"].to_pylist(), batch["members"], batch["members_b"]):
            x, y = _block(left), _block(right)
            va, vb = ([v.values.to_numpy() for v in z["values"]] for z in (x, y))
            shared = _Incidence(va, vb).shared(len(va), len(vb))
            low, high = np.minimum(x["n"][:, None], y["n"][None]), np.maximum(x["n"][:, None], y["n"][None])
            need = np.minimum(SHARED, np.ceil(THRESHOLD * high))
            i, j = np.nonzero((shared >= need) & (x["root"][:, None] != y["root"][None]) & (low >= THRESHOLD * high))
            first = _first_common(va, x["listed"], vb, y["listed"], i, j) == value
            found = np.unique(np.concatenate([x["cls"][i[first]], y["cls"][j[first]]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), value)), pa.array(found)], ["value", "cls"])


def _first_common(va: list, la: np.ndarray, vb: list, lb: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest value that is listed for both members of each pair (i, j)."""
    lists = [v[(mask >> np.arange(len(v))) & 1 == 1] for v, mask in zip([*va, *vb], [*la, *lb])]
    pool, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    table = np.zeros((len(lists), len(pool)), bool)
    table[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), inverse] = True
    out = np.empty(len(i), np.int64)
    for begin in range(0, len(i), 1024):
        part = slice(begin, begin + 1024)
        out[part] = pool[(table[i[part]] & table[j[part] + len(va)]).argmax(axis=1)]
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of two blocks that join their components as all links between the blocks do."""
    for batch in batches:
        for left, right in zip(batch["members"], batch["members_b"]):
            x, y = _block(left), _block(right)
            sa, sb = ([np.frombuffer(s.as_buffer(), np.int64) for s in z["set"]] for z in (x, y))
            shared = _Incidence(sa, sb).shared(len(sa), len(sb))
            total = np.array([len(s) for s in sa])[:, None] + np.array([len(s) for s in sb])[None]
            i, j = np.nonzero((shared >= THRESHOLD * (total - shared)) & (x["root"][:, None] != y["root"][None]))
            roots, one = np.unique(np.stack([x["root"][i], y["root"][j]]), axis=1, return_index=True)
            one = one[_forest(roots)]
            yield pa.RecordBatch.from_arrays([pa.array(x["cls"][i[one]]), pa.array(y["cls"][j[one]])], ["a", "b"])


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Which of the pairs (2 x n) join components that earlier ones did not."""
    parent: dict[int, int] = {}
    keep = np.zeros(pairs.shape[1], bool)
    for at, (a, b) in enumerate(pairs.T.tolist()):
        ends = []
        for x in (a, b):
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            ends.append(x)
        if ends[0] != ends[1]:
            parent[max(ends)] = min(ends)
            keep[at] = True
    return keep
