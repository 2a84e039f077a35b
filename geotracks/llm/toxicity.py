"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of the vectors of its hashed spelling and of its hashed beginnings of
four, five and six bytes. Filters of one, two and three words run over a whole text; the largest
value of each filter goes to a logistic output. Training starts from vectors whose first
component is the log odds of the word between toxic and other texts.

The model is fitted on a bounded sample of labelled rows: about ``max_rows`` ids of either label,
chosen by a hash of the id, one row of each, of at most ``max_words`` words, and ``max_bytes`` of
words in all. One task learns from them. Rows held out are never among them. All rows are scored,
on their whole text.

Thresholds are calibrated by language: for each language of the sample that has both labels, the
one with the best F1 on rows kept from training. They decide ``toxic``; the score does not know
the language.

Null and empty texts are scored like a text without words. Repeated rows get one score. Without
labelled rows of both kinds every score is the base rate, 0 without labels. An empty table gives
no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotracks.llm.common import Words, folded_ascii, slices

SLOTS = 1 << 15
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
BEGINNINGS = (4, 5, 6)
GROUPS = 1 + len(BEGINNINGS)
#: The row of the table that is always zero: it pads texts.
PAD = SLOTS * GROUPS
DEFAULT_THRESHOLD = 0.3

_FOLD = folded_ascii()
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word (words x GROUPS), and the words before each text."""
    words = Words(texts, _INSIDE, _FOLD)
    columns = [words.hashes() % np.uint64(SLOTS)]
    for group, n in enumerate(BEGINNINGS, 1):
        head = words.hashes(words.begin, np.minimum(words.end, words.begin + n))
        columns.append(head % np.uint64(SLOTS) + np.uint64(group * SLOTS))
    return np.stack(columns, axis=1).astype(np.int32), words.first


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    base: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, rows: np.ndarray, first: np.ndarray, places: bool = False):
        """The largest value of each filter in each text, and where it is."""
        padded, first = _pad(rows, first)
        x = self.table[padded].sum(axis=1)
        n, values, at = len(first) - 1, [], []
        for k, w in zip(WIDTHS, self.filters):
            z = sum(x[i : len(x) - k + 1 + i] @ w[i] for i in range(k))
            starts = first[:-1]
            # three pads end each text, so any text, an empty one too, reaches the value 0; windows
            # that begin at the last two would reach into the next text
            for last in (1, 2):
                z[(first[1:] - last)[first[1:] - last < len(z)]] = 0
            values.append(np.maximum.reduceat(z, starts, axis=0) if n else np.empty((0, FILTERS), np.float32))
            if places:
                at.append(np.stack([a + z[a : min(b, len(z))].argmax(axis=0) for a, b in zip(first, first[1:])]))
        pooled = np.maximum(np.concatenate(values, axis=1) + self.bias, 0)
        return (pooled, at, padded, x) if places else pooled

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(self.out):
            return np.full(len(texts), self.base)
        pooled = self.pooled(*features(texts)).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(pooled @ self.out[:-1] + self.out[-1], -30, 30)))


def _pad(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with three padding words after each, so that no window spans two texts."""
    n = len(first) - 1
    starts = first + 3 * np.arange(n + 1)
    out = np.full((int(starts[-1]), GROUPS), PAD, np.int32)
    out[np.arange(len(rows)) + 3 * np.repeat(np.arange(n), np.diff(first))] = rows
    return out, starts


def train(sets: list[np.ndarray], labels: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 7) -> Model:
    """A model of texts given by their words' table rows (words x GROUPS)."""
    labels = labels.astype(np.float64)
    base = float(labels.mean()) if len(labels) else 0.0
    if base in (0.0, 1.0):
        return Model(np.empty(0), [], np.empty(0), np.empty(0), base)
    draw = np.random.default_rng(seed)
    table = (draw.normal(0, 0.01, (PAD + 1, SIZE))).astype(np.float32)
    table[:, 0] = _log_odds(sets, labels)
    table[PAD] = 0
    filters = [draw.normal(0, 0.3 / k, (k, SIZE, FILTERS)).astype(np.float32) for k in WIDTHS]
    for w in filters:
        w[:, 0, : FILTERS // 2] = 0.5 / len(w)
    width = FILTERS * len(WIDTHS)
    model = Model(table, filters, np.zeros(width, np.float32), np.append(np.full(width, 0.2), -1.0), base)
    state: dict[str, tuple] = {}
    weight = np.where(labels > 0, 0.5 / base, 0.5 / (1 - base)) ** 0.5
    step = 0
    for epoch in range(epochs):
        order = draw.permutation(len(sets))
        for begin in range(0, len(order), 64):
            pick = order[begin : begin + 64]
            rows = np.concatenate([sets[i] for i in pick])
            first = np.concatenate(([0], np.cumsum([len(sets[i]) for i in pick])))
            pooled, at, padded, x = model.pooled(rows, first, places=True)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out[:-1] + model.out[-1], -30, 30)))
            error = (p - labels[pick]) * weight[pick] / len(pick)
            down = error[:, None] * model.out[None, :-1] * (pooled > 0)
            grads = {"out": np.append(pooled.T @ error, error.sum()) + 1e-4 * model.out, "bias": down.sum(axis=0)}
            touched, pushed = [], []
            for g, (k, w) in enumerate(zip(WIDTHS, model.filters)):
                d = down[:, g * FILTERS : (g + 1) * FILTERS].astype(np.float32)
                grad = np.zeros_like(w)
                for i in range(k):
                    seen = x[np.minimum(at[g] + i, len(x) - 1)]
                    grad[i] = np.einsum("tfd,tf->df", seen, d)
                    touched.append(np.minimum(at[g] + i, len(x) - 1).ravel())
                    pushed.append((d[:, :, None] * w[i].T[None]).reshape(-1, SIZE))
                grads[f"filter{g}"] = grad
            step += 1
            for name, grad in grads.items():
                target = model.filters[int(name[6:])] if name.startswith("filter") else getattr(model, name)
                _adam(target, grad, state, name, step, rate)
            rows_at = padded[np.concatenate(touched)]
            push = np.repeat(np.concatenate(pushed), GROUPS, axis=0)
            unique, inverse = np.unique(rows_at.ravel(), return_inverse=True)
            total = np.zeros((len(unique), SIZE), np.float32)
            np.add.at(total, inverse, push)
            model.table[unique] -= 2.0 * rate * total / (np.sqrt((total**2).mean(axis=1, keepdims=True)) + 1e-3)
            model.table[PAD] = 0
    return model


def _adam(target: np.ndarray, grad: np.ndarray, state: dict, name: str, step: int, rate: float) -> None:
    m, v = state.setdefault(name, (np.zeros_like(target), np.zeros_like(target)))
    m += 0.1 * (grad - m)
    v += 0.01 * (grad**2 - v)
    target -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(target.dtype)


def _log_odds(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.zeros((2, PAD + 1))
    for rows, label in zip(sets, labels):
        counts[int(label), np.unique(rows)] += 1
    share = (counts + 0.5) / (np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]]) + 1)
    odds = np.log(share[1] / share[0])
    # what few texts hold says little
    return (np.clip(odds, -2, 4) * np.minimum(1, counts.sum(axis=0) / 5) * 0.5).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_words: int = 4000, max_bytes: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model fitted on a bounded sample of ``labels`` (id, toxic) that is not held out."""
    known = labels.where("toxic in (0, 1)").select(F.col(id_col).alias("_id"), "toxic").where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    sizes = {row[0]: row[1] for row in known.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, max_rows / max(1, sizes.get(1, 0))).otherwise(max_rows / max(1, sizes.get(0, 0)))
    # a hash of the id picks about max_rows of either label, so this side has a bounded size
    chosen = known.where((F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / (1 << 30)) < rate)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).join(F.broadcast(chosen), "_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                found, first = features(piece["_text"])
                sets = [found[a:b].tobytes() if b - a <= max_words else None for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([piece["_id"], piece["toxic"], piece["_lang"], pa.array(sets, pa.binary())], ["_id", "toxic", "_lang", "words"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_learned(batches, sizes, max_bytes))], pa.binary())], ["model"])

    kind = rows.schema["_id"].dataType.simpleString()
    sampled = rows.mapInArrow(words, f"_id {kind}, toxic int, _lang string, words binary").where("words is not null")
    # an id that many rows have gives one row, told by its own content
    one = sampled.groupBy("_id").agg(F.min_by(F.struct("toxic", "_lang", "words"), F.xxhash64("words", "_lang")).alias("row")).select("_id", "row.*")
    # the bounded sample is learned from in one task: the driver gets the model alone
    trained = one.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id").mapInArrow(learn, "model binary").first()
    return pickle.loads(trained["model"]) if trained else train([], np.empty(0))


def _learned(batches: Iterator[pa.RecordBatch], sizes: dict, max_bytes: int) -> Model:
    """The model of the rows that come first, up to ``max_bytes`` of words."""
    taken, held = [], 0
    for batch in batches:
        ends = held + np.cumsum([len(x.as_buffer()) for x in batch["words"]], dtype=np.int64)
        fits = int(np.searchsorted(ends, max_bytes, "right"))
        taken.append(batch.slice(0, fits))
        held = int(ends[-1]) if len(ends) else held
        if fits < len(batch):
            break
    if not sum(map(len, taken)):
        return train([], np.empty(0))
    sample = pa.Table.from_batches(taken)
    sample = sample.take(pc.sort_indices(sample["_id"]))
    sets = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, GROUPS) for x in sample["words"]]
    toxic = sample["toxic"].to_numpy()
    # every fifth row calibrates
    check = np.arange(len(sets)) % 5 == 0
    model = train([s for s, c in zip(sets, check) if not c], toxic[~check])
    if len(model.out):
        _calibrate(model, [s for s, c in zip(sets, check) if c], toxic[check], np.array(sample["_lang"].to_pylist(), object)[check], sizes)
    return model


def _calibrate(model: Model, sets: list[np.ndarray], toxic: np.ndarray, lang: np.ndarray, sizes: dict) -> None:
    """Fits the output's slope and offset, and a threshold for each language."""
    if not len(sets) or toxic.min() == toxic.max():
        return
    pooled = np.concatenate([model.pooled(s, np.array([0, len(s)])) for s in sets]).astype(np.float64)
    raw = pooled @ model.out[:-1] + model.out[-1]
    # the sample's labels count as often as the labels of all rows do
    share = np.where(toxic == 1, sizes[1] / (toxic == 1).sum(), sizes[0] / (toxic == 0).sum())
    share = share / share.sum()
    soft = np.where(toxic == 1, 0.995, 0.005)
    slope, offset = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))
        error = share * (p - soft)
        slope, offset = slope - 0.5 * float((error * raw).sum()), offset - 0.5 * float(error.sum())
    slope = max(slope, 0.1)
    model.out[:-1] *= slope
    model.out[-1] = model.out[-1] * slope + offset
    score = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))
    for name in {x for x in lang if x is not None}:
        of = lang == name
        hits = [(_f1(score[of] >= t, toxic[of]), -abs(t - DEFAULT_THRESHOLD), t) for t in np.arange(0.1, 0.91, 0.05)]
        if toxic[of].min() < toxic[of].max():
            model.thresholds[name] = float(max(hits)[2])


def _f1(said: np.ndarray, truth: np.ndarray) -> float:
    right = float((said & (truth == 1)).sum())
    return 2 * right / max(1.0, float(said.sum() + (truth == 1).sum()))


def held_out(id_column):
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_score``, by the whole text of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(shared.value.score(piece[text_col]))], [*names, "_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang"):
    """``docs`` with ``_score`` and ``_toxic``: the score reaches its language's threshold."""
    limits = [F.when(F.col(lang_col) == k, v) for k, v in sorted(model.thresholds.items())]
    limit = F.coalesce(*limits, F.lit(DEFAULT_THRESHOLD))
    return score(docs, model, text_col).withColumn("_toxic", F.col("_score") >= limit)
