"""Mixing sources to target weights by hash-threshold histograms.

A row's hash follows from its id, its text, and its number among the rows that repeat both. Words are summed by source and leading hash bits; the
running sum tells the bucket in which a source's budget ends. Only that bucket is split by the
next bits, down to one hash value. So a source's rows below one threshold are taken once more
than its rows above it, and no row is sorted. Thresholds are nested: a larger budget only adds
rows.

A budget of several times a source's words repeats all its rows so often, and the rest is met by
the threshold. The bucket at the end is taken if that comes nearer to the budget.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating. A target stops at
``cap`` times its source's words, and what is above is shared again by weight.

Null texts have no words and take part with size 0. Rows of equal id, and null ids, are taken
each on its own. An empty table gives no rows; a table without words gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotracks.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Bits of the hash by which a level splits, and levels that use up all 64.
BITS, LEVELS = 16, 4


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row of ``docs``."""
    found = take(docs, [id_col], weights, cap, id_col, text_col, source_col)
    return found.select(
        id_col, F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


def take(docs: DataFrame, keep: list[str], weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with _size, _source_size, _target and _times."""
    held = materialize(
        docs.select(
            *keep,
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
            F.col(source_col).alias("_source"),
            F.xxhash64(F.col(id_col), F.col(text_col), F.lit(7)).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    again = _repeats(held)
    held = held.join(again, "_row", "left").withColumn("_hash", F.coalesce("_numbered", "_hash")).drop("_numbered")
    rows = materialize(held.select("_source", F.col("_size").alias("size"), F.col("_hash").alias("hash")))
    sources = materialize(rows.groupBy("_source").agg(F.sum("size").alias("source_size")))
    sources = _targets(sources, weights, cap)
    budgets = sources.select(
        "_source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("times"),
    ).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    cuts = _thresholds(rows, budgets)
    cuts = cuts.select("_source", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("times").alias("_whole"), F.col("cut").alias("_cut"))
    times = (F.col("_whole") + F.when(F.col("_hash") < F.col("_cut"), 1).otherwise(0)).cast("long")
    return _with(held, cuts).select(*keep, "_size", "_source_size", "_target", times.alias("_times"))


def _repeats(held: DataFrame) -> DataFrame:
    """(_row, _numbered): the hashes of rows that repeat an id and a text, by their number."""
    several = held.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    numbered = number(held.select("_hash", "_row").join(materialize(several), "_hash"), [F.col("_hash"), F.col("_row")])
    numbered = materialize(numbered)
    first = numbered.groupBy("_hash").agg(F.min("place").alias("_first"))
    # the first of them keeps its hash
    nth = F.col("place") - F.col("_first")
    return materialize(numbered.join(first, "_hash").select("_row", F.when(nth > 0, F.xxhash64("_hash", nth)).otherwise(F.col("_hash")).alias("_numbered")))


def _with(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's columns; null is a source too."""
    at = sources.withColumnRenamed("_source", "_at")
    return rows.join(at, rows["_source"].eqNullSafe(at["_at"])).drop("_at")


def _targets(sources: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``sources`` (_source, source_size) with ``target``.

    The level L with sum(min(cap * size, L * weight)) = total is found by rounds: those above
    their cap stop there, and the rest share what remains.
    """
    ranked = number(sources, [F.col("_source").isNull(), F.col("_source")])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight).withColumn("most", cap * F.col("source_size")))
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, known = 0.0, -1
    while True:
        over = F.col("most") <= level * F.col("weight")
        full, open_weight, n = ranked.agg(
            F.sum(F.when(over, F.col("most")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.count_if(over)
        ).first()
        if n == known or not open_weight:
            break
        level, known = (total - full) / open_weight, n
    return materialize(ranked.select("_source", "source_size", F.least(F.col("most"), level * F.col("weight")).alias("target")))


def number(table: DataFrame, order: list) -> DataFrame:
    """``table`` with ``place``, from 0, in ``order``: by ranges, with the counts before each."""
    ranged = table.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("_uid", F.monotonically_increasing_id()))
    part = F.shiftright("_uid", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.col("_uid") - F.shiftleft("_part", 33)
    return ranged.withColumn("_part", part).join(before, "_part").withColumn("place", F.col("_before") + inside).drop("_uid", "_part", "_n", "_before")


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` with ``cut``: a source's rows with a smaller hash are taken once more.

    Each level sums the bucket that holds the budget's end by its next bits; ``low`` is that
    bucket's smallest hash, ``rest`` what is left of the budget there.
    """
    ends = materialize(budgets.withColumn("low", F.lit(-(1 << 63)).cast("long")))
    for level in range(1, LEVELS + 1):
        shift = 64 - BITS * level
        bucket = F.shiftright("hash", shift)
        inside = _with(rows, ends.select("_source", "low"))
        if level > 1:
            inside = inside.where(F.shiftright("hash", shift + BITS) == F.shiftright("low", shift + BITS))
        sums = inside.groupBy("_source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("_source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("words").over(run)).withColumnRenamed("_source", "_at")
        near = ends.drop("words").join(sums, ends["_source"].eqNullSafe(sums["_at"]), "left")
        # the first bucket whose end is beyond the rest; with none, the last one
        beyond = near.groupBy("_source", "source_size", "target", "times", "rest", "low").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", "words", "upto"))).alias("at"),
        )
        ends = materialize(
            beyond.select(
                "_source", "source_size", "target", "times",
                F.when(F.col("at").isNull(), F.col("rest")).otherwise(F.col("rest") - F.col("at.upto") + F.col("at.words")).alias("rest"),
                F.coalesce(F.shiftleft("at.bucket", shift), F.col("low")).alias("low"),
                F.col("at.words").alias("words"),
            )
        )
    nearer = F.col("rest") > F.coalesce("words", F.lit(0)) - F.col("rest")
    return ends.select("_source", "source_size", "target", "times", (F.col("low") + F.when(nearer, 1).otherwise(0)).alias("cut"))
