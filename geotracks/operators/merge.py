"""Merging a source layer into a target layer: update, append, or both.

The result is that of reading the source rows one by one in ``order_by`` order, each
looking up the first target row with its key and seeing what earlier rows appended. It is
computed from one summary row per source key, so a key with very many source rows costs an
aggregate with map-side partials, not a long group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geotracks.operators.ordering import number_rows, with_previous
from geotracks.session import materialize

MODES = ("default", "update_only", "append_only")
_FLOATS = (T.DoubleType, T.FloatType, T.DecimalType)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class MergeResult:
    """``counts``: one row, updated / appended / failed_updates / failed_appends."""

    features: DataFrame
    counts: DataFrame
    rejects: DataFrame
    notices: tuple[str, ...] = ()


def field_list(text: str) -> list[str]:
    """Field names separated by commas, else by blanks; empty text is an empty list."""
    if text == "":
        return []
    return text.split("," if "," in text else " ")


def comparable(source: DataFrame, target: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Same number of fields, and at each place the same name (any case) and type."""
    a = [f for f in source.schema if f.name not in ignore]
    b = [f for f in target.schema if f.name not in ignore]
    return len(a) == len(b) and all(
        f.name.lower() == g.name.lower() and f.dataType == g.dataType for f, g in zip(a, b)
    )


def merge_features(
    source: DataFrame,
    target: DataFrame,
    order_by: str,
    on: str | None = None,
    mode: str = "default",
    preserve_fid: bool = False,
    compare: bool = False,
    select: Sequence[str] | None = None,
    dry_run: bool = False,
    skip_failures: bool = False,
    fid: str = "fid",
) -> MergeResult:
    """Merge ``source`` into ``target``, matching on ``fid`` or on the field ``on``.

    ``order_by`` is a unique source column that orders its rows; when it is no target
    column it serves only as the order. ``compare`` skips updates that change nothing.
    ``select`` updates only the listed fields, cast to the target's type, and needs mode
    ``update_only``. ``preserve_fid`` keeps source fids on append; one that is taken is a
    failed append. A failure raises, unless ``skip_failures`` sends it to ``rejects``.
    """
    notices = _check(source, target, on, mode, select)
    order_only = order_by not in target.columns
    layout = source.drop(order_by) if order_only else source
    if select is not None and compare:
        notices += ("compare is ignored with select",)
        compare = False
    if compare and not comparable(layout, target, ignore=[fid]):
        notices += ("compare is ignored: the layouts differ",)
        compare = False

    in_source = {c.lower() for c in layout.columns}
    fields = [c for c in target.columns if c.lower() in in_source and c != fid]
    written = fields if select is None else [c for c in fields if c in select]
    recast = [c for c in written if source.schema[_named(source, c)].dataType != target.schema[c].dataType]
    # Stored: the plan is made from the keys and the order alone, and its rows are fetched after.
    rows = materialize(
        source.select(
            F.col(order_by).alias("_seq"),
            F.col(fid).alias("_src_fid"),
            _key(source, target, on or fid, source).alias("_key"),
            F.struct(*[F.col(c).alias(c) for c in fields]).alias("_row"),
        )
    )
    first = _first_per_key(target, on or fid, fid, fields, source, keep_row=compare)

    rejects = []
    if preserve_fid and on is not None and mode != "update_only" and not dry_run:
        taken = _taken_fids(rows, first, target, fid)
        rows = rows.join(taken.select("_seq"), "_seq", "left_anti")
        rejects.append(_reject(taken, F.col("_src_fid"), "append", _TAKEN, F.lit(1)))
    plan = materialize(_actions(_summarize(rows, first, mode, compare, dry_run), mode, dry_run))
    writes = plan.where("updates > 0 AND _target_fid IS NOT NULL")
    appends = plan.where("appends > 0")
    if recast and not dry_run:
        bad = _does_not_fit(recast, target)
        reason = "value does not fit the target type"
        rejects.append(_reject(writes.where(bad), F.col("_target_fid"), "update", reason, F.col("updates")))
        rejects.append(_reject(appends.where(bad), F.col("_src_fid"), "append", reason, F.col("appends")))
        writes, appends = writes.where(~bad), appends.where(~bad)
    rejected = target.sparkSession.createDataFrame([], _REJECTS)
    for part in rejects:
        rejected = rejected.unionByName(part)
    if rejects and not skip_failures:
        _raise_first(rejected)

    features = target
    if not dry_run:
        features = _updated(target, writes, fid, written)
        if mode != "update_only":
            features = features.unionByName(_appended(target, appends, fid, fields, preserve_fid))
    return MergeResult(features, _counts(plan, rejected), rejected, notices)


_TAKEN = "fid is taken"
_REJECTS = "fid long, action string, reason string, features long"


def _named(df: DataFrame, name: str) -> str:
    return next(c for c in df.columns if c.lower() == name.lower())


def _check(source, target, on, mode, select) -> tuple[str, ...]:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if select is not None and mode != "update_only":
        raise ValueError("select needs mode update_only")
    for name in [*([on] if on else []), *(select or [])]:
        if name not in source.columns:
            raise ValueError(f"no field {name!r} in the source layer")
        if name not in target.columns:
            raise ValueError(f"no field {name!r} in the target layer")
    return ()


def _key(source: DataFrame, target: DataFrame, name: str, side: DataFrame) -> Column:
    """Key compared as double or integer when both sides are of that kind, else as text."""
    types = source.schema[name].dataType, target.schema[name].dataType
    for kinds, common in ((_FLOATS, "double"), (_INTEGERS, "long")):
        if all(isinstance(t, kinds) for t in types):
            return side[name].cast(common)
    return side[name].cast("string")


def _first_per_key(target, name, fid, fields, source, keep_row) -> DataFrame:
    """The target row a key finds: the one with the lowest fid."""
    keyed = target.select(
        _key(source, target, name, target).alias("_key"),
        F.col(fid).alias("_fid"),
        *([F.struct(*fields).alias("_old")] if keep_row else []),
    ).where("_key IS NOT NULL")
    if name == fid:
        return keyed.withColumnRenamed("_fid", "_target_fid")
    return keyed.groupBy("_key").agg(
        F.min("_fid").alias("_target_fid"),
        *([F.min_by("_old", "_fid").alias("_old")] if keep_row else []),
    )


def _summarize(rows, first, mode, compare, dry_run) -> DataFrame:
    """One row per source key, with the target row it finds and its number of real changes.

    Keys are counted by their order alone. The row whose values are written is joined back by
    its place in the order, which is unique.
    """
    keyed = rows.where("_key IS NOT NULL")
    counted = [
        F.count("*").alias("n"),
        F.min("_seq").alias("_seq"),
        F.max("_seq").alias("_last"),
        F.min_by("_src_fid", "_seq").alias("_src_fid"),
    ]
    if not compare:
        per_key = keyed.groupBy("_key").agg(*counted).join(first, "_key", "left")
        per_key = per_key.withColumns({"changed": F.col("n"), "later": F.col("n") - 1})
    elif dry_run:
        # Nothing is written, so every row is compared with the target itself.
        differs = ~F.col("_row").eqNullSafe(F.col("_old"))
        per_key = (
            keyed.join(first, "_key", "left")
            .groupBy("_key")
            .agg(
                *counted,
                F.max("_target_fid").alias("_target_fid"),
                F.count_if(differs).alias("changed"),
                F.count_if(differs).alias("later"),
            )
        )
    else:
        walked = with_previous(keyed, F.struct("_row"), ["_seq"], ["_key"], name="_before")
        moved = F.col("_before").isNotNull() & ~F.col("_row").eqNullSafe(F.col("_before._row"))
        starts = keyed.select("_seq", F.col("_row").alias("_start"))
        same = F.col("_start").eqNullSafe(F.col("_old"))
        per_key = (
            walked.groupBy("_key")
            .agg(*counted, F.count_if(moved).alias("later"))
            .join(first, "_key", "left")
            .join(starts, "_seq")
            .withColumn("changed", F.col("later") + (~same).cast("int"))
        )
    value = F.col("_row").alias("_value")
    if dry_run:
        per_key = per_key.withColumn("_value", F.lit(None).cast(rows.schema["_row"].dataType))
    elif mode == "append_only":
        per_key = per_key.join(keyed.select("_seq", value), "_seq")
    else:
        per_key = per_key.join(keyed.select(F.col("_seq").alias("_last"), value), "_last")
    # A null key matches nothing, so each such row stands alone.
    columns = ["n", "_seq", "_src_fid", "_value", "_target_fid", "changed", "later"]
    alone = rows.where("_key IS NULL").select(
        F.lit(1).cast("long").alias("n"),
        "_seq",
        "_src_fid",
        value,
        F.lit(None).cast(first.schema["_target_fid"].dataType).alias("_target_fid"),
        F.lit(1).cast("long").alias("changed"),
        F.lit(0).cast("long").alias("later"),
    )
    return per_key.select(*columns).unionByName(alone)


def _actions(summary: DataFrame, mode: str, dry_run: bool) -> DataFrame:
    """Adds the number of updates and appends each key makes."""
    matched = F.col("_target_fid").isNotNull()
    zero = F.lit(0).cast("long")
    if mode == "update_only":
        updates, appends = F.when(matched, F.col("changed")).otherwise(zero), zero
    elif dry_run:
        updates = F.when(matched, F.col("changed")).otherwise(zero)
        appends = F.when(matched, zero).otherwise(F.col("n"))
    else:
        updates = F.when(matched, F.col("changed")).otherwise(F.col("later"))
        appends = F.when(matched, zero).otherwise(F.lit(1))
    if mode == "append_only":
        updates = zero
    return summary.withColumns({"updates": updates.cast("long"), "appends": appends.cast("long")})


def _taken_fids(rows: DataFrame, first: DataFrame, target: DataFrame, fid: str) -> DataFrame:
    """Rows that would be appended under a fid the target already has.

    They fail until a row of the same key comes through; rows after it are updates.
    """
    unmatched = rows.join(first.select("_key"), "_key", "left_anti")
    known = target.select(F.col(fid).alias("_src_fid"))
    through = (
        unmatched.where("_key IS NOT NULL")
        .join(known, "_src_fid", "left_anti")
        .groupBy("_key")
        .agg(F.min("_seq").alias("_through"))
    )
    return (
        unmatched.join(known, "_src_fid", "left_semi")
        .join(through, "_key", "left")
        .where("_through IS NULL OR _seq < _through")
        .select("_seq", "_src_fid")
    )


def _does_not_fit(columns: Sequence[str], target: DataFrame) -> Column:
    """True where a value is there but cannot become the target's type."""
    bad = F.lit(False)
    for name in columns:
        value = F.col("_value")[name]
        bad = bad | (value.isNotNull() & value.try_cast(target.schema[name].dataType).isNull())
    return bad


def _reject(df: DataFrame, fid: Column, action: str, reason: str, features: Column) -> DataFrame:
    return df.select(
        fid.cast("long").alias("fid"),
        F.lit(action).alias("action"),
        F.lit(reason).alias("reason"),
        features.cast("long").alias("features"),
    )


def _raise_first(rejects: DataFrame) -> None:
    worst = rejects.first()
    if worst is not None:
        raise ValueError(f"{worst['action']} of fid {worst['fid']} failed: {worst['reason']}")


def _counts(plan: DataFrame, rejected: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    action = lambda name: F.when(F.col("action") == name, F.col("features")).otherwise(0)
    planned = plan.select(
        F.col("updates").alias("updated"),
        F.col("appends").alias("appended"),
        zero.alias("failed_updates"),
        zero.alias("failed_appends"),
    )
    # Rows with a taken fid left before the plan was made; misfits are still counted in it.
    in_plan = (F.col("reason") != _TAKEN).cast("long")
    failed = rejected.select(
        (-action("update") * in_plan).alias("updated"),
        (-action("append") * in_plan).alias("appended"),
        action("update").alias("failed_updates"),
        action("append").alias("failed_appends"),
    )
    both = planned.unionByName(failed)
    return both.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in both.columns])


def _updated(target: DataFrame, writes: DataFrame, fid: str, fields: Sequence[str]) -> DataFrame:
    hits = writes.select(F.col("_target_fid").alias(fid), F.struct("_value").alias("_hit"))
    joined = target.join(hits, fid, "left")
    return joined.select(
        *[
            F.when(
                F.col("_hit").isNotNull(), _as(F.col("_hit._value")[c], target.schema[c].dataType)
            )
            .otherwise(F.col(c))
            .alias(c)
            if c in fields
            else F.col(c)
            for c in target.columns
        ]
    )


def _appended(target, appends, fid, fields, preserve_fid) -> DataFrame:
    fid_type = target.schema[fid].dataType
    values = [
        _as(F.col("_value")[c] if c in fields else F.lit(None), target.schema[c].dataType).alias(c)
        for c in target.columns
        if c != fid
    ]
    if preserve_fid:
        fresh = appends.select(F.col("_src_fid").cast(fid_type).alias(fid), *values)
    else:
        start = target.agg(F.max(fid)).first()[0] or 0
        numbered = number_rows(appends.select("_seq", "_value"), ["_seq"], name="_ordinal")
        fresh = numbered.select((F.lit(start) + F.col("_ordinal")).cast(fid_type).alias(fid), *values)
    return fresh.select(*target.columns)


def _as(value: Column, data_type: T.DataType) -> Column:
    """Values that do not fit were rejected before, so nothing is lost here."""
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return value.cast(data_type)
    return value.try_cast(data_type)
