"""Language identification by Bayesian evidence fusion.

The posterior of a row's language is the product of three parts:

* the text's likelihood, from hashed byte trigrams. A text counts as at most ``WEIGHT`` trigrams,
  as neighbouring ones are far from independent;
* the likelihood of the declared language given each language, from grouped sums over all rows;
* the prior of the row's host, smoothed by its domain's, that by its address suffix's, and that
  by the whole table's. The counts are the sums of the texts' posteriors by host, over all rows.

Trigram profiles are fitted on about ``max_rows`` labelled texts of each language, chosen by a
hash of id and text; the languages are the at most ``MAX_LANGUAGES`` most frequent labels.

"None of these" is one more hypothesis next to the languages, with counts by host and declaration
like theirs. Its likelihood is that of a limit for each trigram, set for each language on a fifth
of the sample that a trial profile leaves out: half-way between the language's own texts (their
lowest hundredth) and the nearest foreign ones, and never less likely than evenly drawn trigrams.

A row is rejected (language null) if its text has no trigram, or no language reaches
``least`` posterior. ``_probability`` is that of the best language. Null texts and hosts, and undeclared languages, are missing evidence.
Repeated rows get one answer. An empty table gives no rows; without labelled texts all rows are
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotracks.llm.common import folded_ascii, slices
from geotracks.session import materialize

BUCKETS = 1 << 14
WEIGHT = 60
MAX_LANGUAGES = 64
#: Rows by which a level of the host hierarchy is held to the level above it.
SMOOTH = 20.0

_FOLD = folded_ascii()


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each byte trigram of letters and spaces, and each trigram's text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    data = _FOLD[data[offsets[0] : offsets[-1]]].astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    plain = ((data >= 97) & (data <= 122)) | (data >= 128)
    space = data == 32
    use = (row[:-2] == row[2:]) & (plain | space)[:-2] & plain[1:-1] & (plain | space)[2:]
    code = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA77)) ^ (data[2:] * np.uint32(0xC2B2AE3D))
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((code >> np.uint32(18)) % np.uint32(BUCKETS))[use].astype(np.int64), row[:-2][use]


def fit(docs: DataFrame, max_rows: int = 8000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the log probabilities of their trigrams (languages x BUCKETS), and their limits."""
    labelled = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).where("_lang is not null")
    sizes = labelled.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return [], np.zeros((0, BUCKETS)), np.zeros(0)
    rate = F.create_map(*(F.lit(x) for r in sizes for x in (r["_lang"], min(1.0, max_rows / r["count"]))))[F.col("_lang")]
    chosen = labelled.where(F.pmod(F.xxhash64("_id", "_text", F.lit(3)), F.lit(1 << 30)) < rate * (1 << 30))
    chosen = chosen.withColumn("_held", F.pmod(F.xxhash64("_id", "_text", F.lit(5)), F.lit(5)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, bool], np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch, "_text"):
                bucket, row = trigrams(piece["_text"])
                langs = np.array(piece["_lang"].to_pylist(), object)
                held = np.array(piece["_held"].to_pylist(), bool)
                for lang in set(langs):
                    for h in (False, True):
                        of = bucket[((langs == lang) & (held == h))[row]]
                        totals[lang, h] = totals.get((lang, h), 0) + np.bincount(of, minlength=BUCKETS)
        for (lang, h), counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([h] * len(at), pa.bool_()), pa.array(at), pa.array(counts[at])], ["lang", "held", "bucket", "n"])

    sums = chosen.mapInArrow(count, "lang string, held boolean, bucket long, n long").groupBy("lang", "held", "bucket").agg(F.sum("n").alias("n"))
    # at most MAX_LANGUAGES times BUCKETS counts, twice
    table = materialize(sums).toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((2, len(languages), BUCKETS))
    if table.num_rows:
        counts[table["held"].to_numpy().astype(int), [place[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    return languages, _profiles(counts.sum(axis=0)), _limits(chosen.where("_held"), languages, _profiles(counts[0]))


def _profiles(counts: np.ndarray) -> np.ndarray:
    counts = counts + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _limits(held: DataFrame, languages: list[str], profiles: np.ndarray) -> np.ndarray:
    """The log likelihood for each trigram below which a text is not of the language."""
    flat = -np.log(BUCKETS)
    if not languages:
        return np.zeros(0)
    shared = held.sparkSession.sparkContext.broadcast(profiles)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                ll, n = log_likelihoods(piece["_text"], shared.value)
                full = np.flatnonzero(n > 0)
                k = ll.shape[1]
                each = ll[full] / np.minimum(n[full], WEIGHT)[:, None]
                yield pa.RecordBatch.from_arrays([piece["_lang"].take(pa.array(np.repeat(full, k))), pa.array(np.tile(np.arange(k), len(full))), pa.array(each.ravel())], ["lang", "k", "mean"])

    found = held.mapInArrow(means, "lang string, k long, mean double").groupBy("lang", "k").agg(F.percentile_approx("mean", [0.01, 0.5], 1000).alias("q")).collect()
    q = {(r.lang, r.k): r.q for r in found}
    limits = np.full(len(languages), flat)
    for k, lang in enumerate(languages):
        if (lang, k) in q:
            low, middle = q[lang, k]
            foreign = max([float(profiles[k].mean()), *(q[x, k][1] for x in languages if x != lang and (x, k) in q)])
            # of a language like another one, texts well below its own low ones still stay
            limits[k] = max(flat, min((low + foreign) / 2, 2 * low - middle))
    return limits


def log_likelihoods(texts: pa.Array, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) tempered log likelihoods, and the trigrams of each text."""
    bucket, row = trigrams(texts)
    n = np.bincount(row, minlength=len(texts))
    sums = np.stack([np.bincount(row, weights=p[bucket], minlength=len(texts)) for p in profiles], axis=1) if len(profiles) else np.zeros((len(texts), 0))
    return sums / np.maximum(n, 1)[:, None] * np.minimum(n, WEIGHT)[:, None], n


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str, declared_col: str | None, host_col: str | None, least: float = 0.5) -> DataFrame:
    """``rows`` with ``_language`` (null: rejected), ``_probability`` and ``_text_language``.

    Columns of ``rows`` may have any names that do not begin with an underscore.
    """
    languages, profiles, limits = model
    if not languages:
        return rows.withColumns({"_language": F.lit(None).cast("string"), "_probability": F.lit(None).cast("double"), "_text_language": F.lit(None).cast("string")})
    shared = rows.sparkSession.sparkContext.broadcast((profiles, limits))
    names = rows.columns
    given = rows.withColumn("_declared", F.col(declared_col) if declared_col else F.lit(None).cast("string"))
    given = given.withColumn("_host", F.col(host_col) if host_col else F.lit(None).cast("string"))

    def likelihoods(keep: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, text_col):
                    profiles, limits = shared.value
                    ll, n = log_likelihoods(piece[text_col], profiles)
                    # the last entry: none of the languages
                    none = limits[ll.argmax(axis=1)] * np.minimum(n, WEIGHT)
                    ll = np.concatenate([ll, none[:, None]], axis=1)
                    values = pa.ListArray.from_arrays(pa.array(np.arange(len(ll) + 1, dtype=np.int32) * ll.shape[1]), pa.array(ll.ravel()))
                    yield pa.RecordBatch.from_arrays([*(piece[c] for c in keep), values, pa.array(n)], [*keep, "_ll", "_n"])

        return run

    def with_likelihoods(keep: list[str]) -> DataFrame:
        fields = [f for f in given.schema.fields if f.name in keep]
        schema = T.StructType([*fields, T.StructField("_ll", T.ArrayType(T.DoubleType())), T.StructField("_n", T.LongType())])
        return given.select(*dict.fromkeys([*keep, text_col])).mapInArrow(likelihoods(keep), schema)

    k = len(languages) + 1
    keys = with_likelihoods(["_declared", "_host"]).where("_n > 0").select("_declared", "_host", _softmax("_ll").alias("_p"))
    each = [F.sum(F.col("_p")[i]).alias(f"c{i}") for i in range(k)]
    sums = materialize(keys.groupBy("_declared", "_host").agg(*each))
    again = [F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]
    host = _priors(sums.groupBy("_host").agg(*again), k)
    said = _declared(sums.groupBy("_declared").agg(*again), k)

    out = with_likelihoods([*names, "_declared", "_host"])
    out = out.join(said.withColumnRenamed("_declared", "_d"), F.col("_declared") == F.col("_d"), "left")
    out = out.join(host.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h")), "left")
    total = F.zip_with("_ll", F.coalesce("_said", F.array_repeat(F.lit(0.0), k)), lambda a, b: a + b)
    total = F.zip_with(total, F.coalesce("_prior", F.array_repeat(F.lit(0.0), k)), lambda a, b: a + b)
    out = out.withColumn("_post", _softmax(total))
    best = F.array_max(F.slice("_post", 1, k - 1))
    name = F.array(*map(F.lit, [*languages, None]))

    def which(values):
        return F.element_at(name, F.array_position(values, F.array_max(values)).cast("int"))

    sure = (F.col("_n") > 0) & (best >= least)
    return out.select(*names, F.when(sure, which(F.col("_post"))).alias("_language"), best.alias("_probability"), F.when(F.col("_n") > 0, which(F.col("_ll"))).alias("_text_language"))


def _softmax(values):
    values = F.col(values) if isinstance(values, str) else values
    parts = F.transform(values, lambda v: F.exp(v - F.array_max(values)))
    return F.transform(parts, lambda v: v / F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))


def _smoothed(counts: str, above: str):
    n = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, above, lambda c, p: (c + SMOOTH * p) / (n + SMOOTH))


def _priors(hosts: DataFrame, k: int) -> DataFrame:
    """(_host, _prior): log priors, each level smoothed by the one above it."""
    columns = [f"c{i}" for i in range(k)]
    domain = F.substring_index("_host", ".", -2)
    levels = hosts.withColumn("_domain", domain).withColumn("_suffix", F.substring_index("_host", ".", -1))

    def total(by: list[str], name: str) -> DataFrame:
        return levels.groupBy(*by).agg(F.array(*(F.sum(c) for c in columns)).alias(name))

    everything = total([], "_all").withColumn("_key", F.lit(0))
    suffix = total(["_suffix"], "_of_suffix").withColumn("_key", F.lit(0)).join(everything, "_key")
    n = F.aggregate("_all", F.lit(0.0), lambda a, b: a + b)
    suffix = suffix.withColumn("_p", F.transform("_all", lambda c: (c + 1) / (n + k))).withColumn("_p", _smoothed("_of_suffix", "_p")).select("_suffix", "_p")
    middle = total(["_suffix", "_domain"], "_of_domain").withColumnRenamed("_suffix", "_s")
    middle = middle.join(suffix, F.col("_s").eqNullSafe(F.col("_suffix"))).select(F.col("_domain").alias("_dom"), _smoothed("_of_domain", "_p").alias("_p"))
    last = levels.withColumn("_of_host", F.array(*columns)).join(middle, F.col("_domain").eqNullSafe(F.col("_dom")))
    return last.withColumn("_p", _smoothed("_of_host", "_p")).select("_host", F.transform("_p", lambda p: F.log(p)).alias("_prior"))


def _declared(said: DataFrame, k: int) -> DataFrame:
    """(_declared, _said): log likelihood of the declaration under each language."""
    columns = [f"c{i}" for i in range(k)]
    said = said.where("_declared is not null")
    totals = said.agg(F.count("*").alias("_kinds"), *(F.sum(c).alias(f"t{i}") for i, c in enumerate(columns))).withColumn("_key", F.lit(0))
    both = said.withColumn("_key", F.lit(0)).join(totals, "_key")
    return both.select("_declared", F.array(*(F.log((F.col(f"c{i}") + 1) / (F.col(f"t{i}") + F.col("_kinds"))) for i in range(k))).alias("_said"))


def page_text(html):
    """A page's text without markup, scripts and comments."""
    return F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")


def declared_language(html):
    """The primary tag of the markup's language attribute, in lower case, or null."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    return F.when(found != "", found)
