"""License scans by diagonal voting.

All rolling word pairs of a text are hashed and joined to the word pairs of the templates. A hit
at word p of a text and word t of a template votes for the diagonal p - t, which is where the
template would begin. Votes are summed by diagonal. A diagonal on which all pairs of a template
vote is an exact place of it. Neighbouring diagonals (words put in or left out) are merged by
place: hits are chained in the order of the text, each later in the template than the one before
it and on a diagonal at most ``DRIFT`` away, to either side. A template is verified by the share of
its pairs that its longest chain holds.

Base templates give base labels at exact places. A chain that covers at least ``share`` of any
template gives its label too, and so do the templates of ``OWN``.

Null texts have no words. Very long texts give more rows, not longer ones. Repeated rows are each
scanned. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotracks.llm.common import Words, folded_ascii, mix, slices

#: The phrases whose exact places are counted, and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Further phrases and labels of this method.
OWN = [
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("creative commons attribution", "cc-by"),
    ("permission is hereby granted free of charge", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
]
SHARE = 0.65
#: Words by which the diagonals of neighbours in a chain may differ.
DRIFT = 3

_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True
_FOLD = folded_ascii()
#: The join key of the row that every text sends along with its word count.
_HEADER = 0


def _pairs(words: Words) -> np.ndarray:
    """The hash of each word and the next one, as signed values without the header's key."""
    h = words.hashes()
    both = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) else h
    return (both | np.uint64(1)).view(np.int64)


def template_rows(base=BASE, own=OWN) -> list[tuple]:
    """(pair, template, t, pairs, label, is_base), and the row that matches headers."""
    rows = [(_HEADER, None, None, None, None, None)]
    for number, (phrase, label) in enumerate([*base, *own]):
        found = _pairs(Words(pa.array([phrase]), _INSIDE, _FOLD))
        rows += [(int(h), number, t, len(found), label, number < len(base)) for t, h in enumerate(found)]
    return rows


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["uid", "_id", "pair", "p"]
    for batch in batches:
        for piece in slices(batch, "_text"):
            words = Words(piece["_text"], _INSIDE, _FOLD)
            counts = np.diff(words.first)
            yield pa.RecordBatch.from_arrays(
                [piece["uid"], piece["_id"], pa.array(np.full(len(piece), _HEADER)), pa.array(counts.astype(np.int64))], names
            )
            inside = words.row[:-1] == words.row[1:]
            rows = words.row[:-1][inside]
            place = (np.arange(len(words.row)) - words.first[words.row])[:-1][inside]
            uids = piece["uid"].to_numpy()[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), pa.nulls(len(rows), piece["_id"].type), pa.array(_pairs(words)[inside]), pa.array(place)], names
            )


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The share of each template's pairs that its longest chain in a text holds.

    Hits come by text, template and place. Only those that a chain can still reach are held.
    """
    names = ["_uid", "_template", "covered"]
    key, held, best, size = None, deque(), 0, 1
    for batch in batches:
        done = []
        for uid, template, p, t, pairs in zip(*(batch[c].to_pylist() for c in ("uid", "template", "p", "t", "pairs"))):
            if (uid, template) != key:
                if key is not None:
                    done.append((*key, best / size))
                key, held, best, size = (uid, template), deque(), 0, pairs
            while held and held[0][0] < p - pairs - DRIFT:
                held.popleft()
            length = 1 + max((n for q, u, n in held if q < p and u < t and abs((p - t) - (q - u)) <= DRIFT), default=0)
            held.append((p, t, length))
            best = max(best, length)
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.float64()))], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([best / size])], names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, own=OWN, share: float = SHARE) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    spark = docs.sparkSession
    named = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = named.schema["_id"].dataType.simpleString()
    grams = named.mapInArrow(_grams, f"uid long, _id {kind}, pair long, p long")
    templates = spark.createDataFrame(template_rows(base, own), "pair long, template int, t int, pairs int, label string, is_base boolean")
    # the templates are a fixed list of phrases, so this side has a bounded size
    hits = grams.join(F.broadcast(templates), "pair")

    votes = hits.groupBy("uid", "template", (F.col("p") - F.coalesce("t", F.lit(0))).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.first("pairs").alias("pairs"),
        F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.max("_id").alias("_id"),
    )
    exact = F.col("is_base") & (F.col("votes") == F.col("pairs"))
    places = votes.groupBy("uid", "template").agg(
        F.max("_id").alias("_id"), F.max(F.when(F.col("template").isNull(), F.col("diagonal"))).alias("n_words"), F.first("label").alias("label"),
        F.count_if(exact).alias("n_base"), F.min(F.when(exact, F.col("diagonal"))).alias("first_word"), F.max(F.when(exact, F.col("diagonal"))).alias("last_word"),
    )
    order = ["uid", "template", "p", "t"]
    ranked = hits.where("template is not null").select(*order, "pairs").repartition("uid", "template").sortWithinPartitions(*order)
    chains = ranked.mapInArrow(_chains, "_uid long, _template int, covered double")
    spans = places.join(chains, (F.col("uid") == F.col("_uid")) & (F.col("template") == F.col("_template")), "left")
    found = F.col("n_base") > 0
    return spans.groupBy("uid").agg(
        F.max("_id").alias(id_col), F.max("n_words").alias("n_words"), F.sum("n_base").alias("n_base"),
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found | (F.col("covered") >= share), F.col("label")))), ",").alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.max("covered"), F.lit(0.0))).alias("score"),
    ).drop("uid")
