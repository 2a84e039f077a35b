"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are ordered by label and by 63 concatenated random sign hashes. Every vector
is compared with its neighbours in that order, a window of ``WINDOW`` to twice as many. Links of
all passes give components. The number of passes follows from how crowded the labels are, as
measured over all rows, so that a pair at the threshold is missed by all passes with a probability
of about ``MISS``, also where a label's vectors have a common direction. More passes are then
needed: their number grows with the bits that a label's vectors share.

Link counts are exact within each component, whatever the windows saw: vectors within half the
threshold's angle of the component's first vector are all linked with one another, so these are
counted, not compared; the others are compared with all of the component in blocks. Equal
vectors of a label are one class with a weight.

Vectors that are null, zero, or hold null or non-finite components, and rows without a label,
link with nothing. Repeated rows are vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotracks.llm.common import components
from geotracks.session import materialize

THRESHOLD = 0.93
WINDOW = 64
#: Orders in which crowding is measured.
TRIALS = 3
MISS = 1e-4
BLOCK = 256
BITS = 63


def valid_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's vector in double precision; None for vectors that take no part."""
    out: list[np.ndarray | None] = []
    for row in column:
        vector = None
        if row.is_valid and len(row.values) and row.values.null_count == 0:
            vector = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(vector).all() or not vector.any():
                vector = None
        out.append(vector)
    return out


def passes_for(hit: float) -> int:
    """Passes that all miss a pair with MISS, if one finds it with the probability ``hit``."""
    return max(4, math.ceil(math.log(MISS) / math.log(1 - min(hit, 0.9))))


def _measured_hit(classes: DataFrame, threshold: float, seed: int) -> float:
    """The chance of one pass to bring a pair at the threshold together, in the label with the least.

    Two vectors come as near in the order as those a window apart do if they agree on the bits on
    which these agree. Random planes agree on a pair at the threshold with a known chance for each
    bit, however crowded its label is; how many bits must agree is measured over all rows, in
    ``TRIALS`` orders of keys alone.
    """
    agree = 1 - math.acos(threshold) / math.pi
    label = classes.schema["_label"].dataType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for size in pc.unique(batch["size"]).to_pylist():
                part = batch.filter(pc.equal(batch["size"], size))
                for trial, key in enumerate(_sign_keys(part["vec"], size, TRIALS, seed + 1, planes)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), trial, np.int32)), pa.array(key), part["_label"], part["size"]], names)

    def crowding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if len(held) > WINDOW:
                near, far = held.slice(0, len(held) - WINDOW), held.slice(WINDOW)
                same = pc.and_kleene(pc.and_kleene(pc.equal(near["trial"], far["trial"]), pc.equal(near["size"], far["size"])), pc.equal(near["_label"], far["_label"]))
                differ = (near["key"].to_numpy() ^ far["key"].to_numpy()).astype(np.float64)
                bits = BITS - np.ceil(np.log2(differ + 1))
                yield pa.RecordBatch.from_arrays([near["_label"], near["size"], pa.array(agree**bits)], ["_label", "size", "hit"]).filter(same)
                held = far

    names = ["trial", "key", "_label", "size"]
    keyed = classes.select("_label", "size", "vec").mapInArrow(keys, f"trial int, key long, _label {label}, size int")
    order = ["trial", "size", "_label", "key"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    hits = ranged.mapInArrow(crowding, f"_label {label}, size int, hit double")
    # the most crowded quarter of a label's rows is what counts
    least = hits.groupBy("_label", "size").agg(F.percentile_approx("hit", 0.25, 1000).alias("hit")).agg(F.min("hit")).first()[0]
    return 0.9 if least is None else least


def _sign_keys(vectors: pa.Array, size: int, passes: int, seed: int, planes: dict) -> Iterator[np.ndarray]:
    """For each pass the keys of vectors of one size: the signs against BITS random planes."""
    if size not in planes:
        planes[size] = np.random.default_rng([seed, size]).normal(size=(size // 8, passes * BITS))
    bits = _matrix(vectors) @ planes[size] > 0
    for p in range(passes):
        yield bits[:, p * BITS : (p + 1) * BITS] @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = valid_vectors(batch["_vector"])
        usable = [v if label is not None else None for v, label in zip(vectors, batch["_label"].to_pylist())]
        prints = [
            hashlib.blake2b(v.tobytes() + str(label).encode(), digest_size=16).digest() if v is not None else None
            for v, label in zip(usable, batch["_label"].to_pylist())
        ]
        body = pa.array([v.tobytes() if v is not None else None for v in usable], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["_id"], batch["_label"], body, pa.array(prints, pa.binary())], ["_id", "_label", "vec", "print"])


def link(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    named = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_vector"))
    kinds = [named.schema[c].dataType.simpleString() for c in ("_id", "_label")]
    rows = materialize(named.mapInArrow(_clean, f"_id {kinds[0]}, _label {kinds[1]}, vec binary, print binary"))
    classes = rows.where("vec is not null").groupBy("print").agg(F.min("_id").alias("least"), F.count("*").alias("weight"), F.first("_label").alias("_label"), F.first("vec").alias("vec"))
    # vectors of different sizes are never compared
    classes = materialize(classes.withColumn("size", F.octet_length("vec")).withColumn("cls", F.monotonically_increasing_id()))
    edges = _window_links(classes, passes_for(_measured_hit(classes, threshold, seed)), threshold, seed)
    roots = materialize(components(edges).withColumnRenamed("node", "cls"))
    counts = _counts(classes, roots, threshold)
    known = classes.join(roots, "cls", "left").join(counts, "cls", "left").select(
        "print", "least", F.coalesce("root", "cls").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    known = materialize(known)
    first = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(first, "root").select("print", "n_links", "component_id")
    return rows.select("_id", "print").join(known, "print", "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("print").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _window_links(classes: DataFrame, passes: int, threshold: float, seed: int) -> DataFrame:
    """(a, b): links that connect what the windows of all passes link."""
    label = classes.schema["_label"].dataType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for size in pc.unique(batch["size"]).to_pylist():
                part = batch.filter(pc.equal(batch["size"], size))
                for p, key in enumerate(_sign_keys(part["vec"], size, passes, seed, planes)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), p, np.int32)), pa.array(key), *(part[c] for c in ("_label", "size", "cls", "vec"))], names)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links within a range, and the rows at its two ends."""
        parent: dict[tuple[int, int], tuple[int, int]] = {}
        held, first = None, True
        for batch in batches:
            place = batch["range"][0].as_py() if len(batch) else 0
            for begin in range(0, len(batch), WINDOW):
                part = batch.slice(begin, WINDOW)
                if first:
                    yield ends(part, place, 0)
                    first = False
                yield _window(held, part, threshold, parent)
                held = part if held is None or len(part) == WINDOW else pa.Table.from_batches([held, part]).slice(max(0, len(held) + len(part) - WINDOW)).combine_chunks().to_batches()[0]
        if held is not None:
            yield ends(held, held["range"][0].as_py(), 1)

    def ends(part: pa.RecordBatch, place: int, end: int) -> pa.RecordBatch:
        n = len(part)
        # the last rows of a range meet the first ones of the next
        at = pa.array(np.full(n, place + end, np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), at, *(part[c] for c in ("pass", "_label", "size", "cls", "vec")), pa.array(np.full(n, end, np.int32))], out
        )

    def _window(left, right: pa.RecordBatch, limit: float, parent: dict) -> pa.RecordBatch:
        found = _pairs(left, right, limit)
        kept = []
        for p, x, y in found:
            x, y = _find(parent, (p, x)), _find(parent, (p, y))
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append((x[1], y[1]))
        n = len(kept)
        empty = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), right["_label"].type, pa.int32(), pa.int64(), pa.binary(), pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()), *empty], out)

    def joints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch["tails"], batch["heads"]):
                found = _pairs(_batch(left), _batch(right), threshold, within=False)
                yield pa.RecordBatch.from_arrays([pa.array([x for _, x, _ in found], pa.int64()), pa.array([y for _, _, y in found], pa.int64())], ["a", "b"])

    names = ["pass", "key", "_label", "size", "cls", "vec"]
    out = ["a", "b", "joint", "pass", "_label", "size", "cls", "vec", "end"]
    keyed = classes.select("_label", "size", "cls", "vec").mapInArrow(keys, f"pass int, key long, _label {label}, size int, cls long, vec binary")
    order = ["pass", "size", "_label", "key", "cls"]
    swept = materialize(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
        .mapInArrow(near, f"a long, b long, joint int, pass int, _label {label}, size int, cls long, vec binary, end int")
    )
    # at most 2 * WINDOW rows meet at a joint
    met = swept.where("a is null").groupBy("joint").agg(_rows_at(1).alias("tails"), _rows_at(0).alias("heads")).where("size(tails) > 0 and size(heads) > 0")
    across = met.select("tails", "heads").mapInArrow(joints, "a long, b long")
    return swept.where("a is not null").select("a", "b").unionByName(across).distinct()


def _rows_at(end: int):
    return F.collect_list(F.when(F.col("end") == end, F.struct("pass", "_label", "size", "cls", "vec")))


def _batch(rows: pa.ListScalar) -> pa.RecordBatch:
    held = rows.values
    return pa.RecordBatch.from_arrays([held.field(f.name) for f in held.type], [f.name for f in held.type])


def _find(parent: dict, x):
    while (up := parent.get(x, x)) != x:
        parent[x] = parent.get(up, up)
        x = up
    return x


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one size as rows."""
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column])


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None])


def _pairs(left, right: pa.RecordBatch, limit: float, within: bool = True) -> list[tuple[int, int, int]]:
    """(pass, a, b) of the linked pairs of ``left`` with ``right``, and within ``right``."""
    parts = [x for x in (left, right) if x is not None]
    group = np.array([str(x) for p in parts for x in zip(p["pass"].to_pylist(), p["size"].to_pylist(), p["_label"].to_pylist())], object)
    ids = np.concatenate([p["cls"].to_numpy(zero_copy_only=False) for p in parts])
    vectors = [x for p in parts for x in p["vec"]]
    passes = np.concatenate([p["pass"].to_numpy(zero_copy_only=False) for p in parts])
    split = len(ids) - len(right)
    found = []
    for g in dict.fromkeys(group):
        at = np.flatnonzero(group == g)
        new = at[at >= split]
        if not len(new):
            continue
        x = np.stack([np.frombuffer(vectors[i].as_buffer(), np.float64) for i in at])
        near = _cosines(x, x[at >= split]) >= limit
        i, j = np.nonzero(near & (at[:, None] < new[None]))
        i, j = at[i], new[j]
        if not within:
            i, j = i[i < split], j[i < split]
        found += zip(passes[j].tolist(), ids[i].tolist(), ids[j].tolist())
    return found


def _counts(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(cls, linked): the weight of the other classes that each class of a component links with."""
    half = math.cos(math.acos(threshold) / 2 - 1e-9)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = [float(_cosines(np.frombuffer(v.as_buffer())[None], np.frombuffer(p.as_buffer())[None])[0, 0]) for v, p in zip(batch["vec"], batch["pivot"])]
            core = pa.array(np.array(cosines, np.float64) >= half)
            yield batch.select(["root", "cls", "weight", "vec"]).append_column("core", core)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rim, members in zip(batch["rim"], batch["members"]):
                r, m = _batch(rim), _batch(members)
                linked = _cosines(_matrix(r["vec"]), _matrix(m["vec"])) >= threshold
                rc, mc = r["cls"].to_numpy(), m["cls"].to_numpy()
                linked &= rc[:, None] != mc[None]
                core = m["core"].to_numpy(zero_copy_only=False)
                ids = np.concatenate([rc, mc[core]])
                # a rim class counts all it meets; a core class counts the rim classes here
                n = np.concatenate([linked @ m["weight"].to_numpy(), (r["weight"].to_numpy() @ linked)[core]])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["cls", "linked"])

    held = classes.join(roots, "cls").select("root", "cls", "weight", "vec")
    pivots = classes.select(F.col("cls").alias("root"), F.col("vec").alias("pivot"))
    held = materialize(held.join(pivots, "root").mapInArrow(place, "root long, cls long, weight long, vec binary, core boolean"))
    core = held.where("core").groupBy("root").agg(F.sum("weight").alias("total"))
    among = held.where("core").join(core, "root").select("cls", (F.col("total") - F.col("weight")).alias("linked"))
    sizes = held.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count_if(~F.col("core")).alias("rims")).where("rims > 0")
    rows = held.join(sizes, "root").withColumn("chunk", F.pmod(F.hash("cls"), "blocks").cast("int"))
    packed = F.collect_list(F.struct("cls", "weight", "vec", "core"))
    members = rows.groupBy("root", "chunk").agg(packed.alias("members"))
    rims = rows.where("not core").groupBy("root", "chunk").agg(packed.alias("rim")).drop("chunk")
    met = rims.join(members.drop("chunk"), "root").select("rim", "members").mapInArrow(compare, "cls long, linked long")
    return among.unionByName(met).groupBy("cls").agg(F.sum("linked").alias("linked"))
