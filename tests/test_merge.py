"""Feature merge against a plain loop over the source rows."""

import itertools
import random

import pytest

from geotracks.operators.merge import MODES, comparable, field_list, merge_features

LAYOUT = "fid long, code string, val double, cat int, x double"


def loop(source, target, on, mode, compare, dry_run, preserve, select=None):
    """One source row at a time; rows are dicts, source in order."""
    table = [dict(r) for r in sorted(target, key=lambda r: r["fid"])]
    counts = dict(updated=0, appended=0, failed_updates=0, failed_appends=0)
    fresh = max([r["fid"] for r in table], default=0)
    fixed = {r["fid"] for r in table}
    fields = [f for f in ("code", "val", "cat", "x")]
    for s in source:
        key = s[on or "fid"]
        hit = None
        if key is not None:
            hit = next((t for t in table if t.get(on or "fid") == key and not (on is None and t.get("new"))), None)
        if hit is None:
            if mode == "update_only":
                continue
            if preserve and not dry_run and s["fid"] in fixed:
                counts["failed_appends"] += 1
                continue
            counts["appended"] += 1
            if not dry_run:
                fresh += 1
                table.append({**{f: s[f] for f in fields}, "fid": s["fid"] if preserve else fresh, "new": True})
        elif mode != "append_only":
            if compare and all(s[f] == hit[f] for f in fields):
                continue
            counts["updated"] += 1
            if not dry_run:
                hit.update({f: s[f] for f in (select or fields)})
    return sorted((tuple(r[f] for f in ("fid", *fields)) for r in table), key=repr), counts


@pytest.fixture(scope="module")
def layers():
    rng = random.Random(11)
    target = [
        dict(fid=i, code=f"K{i % 17}", val=float(i % 3), cat=i % 4, x=float(i % 2)) for i in range(1, 30)
    ]
    target.append(dict(fid=40, code=None, val=1.0, cat=None, x=None))
    source = []
    for seq in range(80):
        code = None if seq % 9 == 4 else "K3" if seq % 3 == 0 else f"K{rng.randrange(30)}"
        fid = seq + 25
        source.append(
            dict(fid=fid, seq=seq, code=code, val=float(rng.randrange(2)), cat=None if seq % 5 == 0 else 1, x=float(seq % 2))
        )
    return source, target


def frames(spark, source, target):
    src = spark.createDataFrame(
        [(r["fid"], r["seq"], r["code"], r["val"], r["cat"], r["x"]) for r in source],
        LAYOUT.replace("fid long,", "fid long, seq int,"),
    ).repartition(5)
    dst = spark.createDataFrame([tuple(r.values()) for r in target], LAYOUT).repartition(3)
    return src, dst


@pytest.mark.parametrize("on", ["code", None])
@pytest.mark.parametrize("mode", MODES)
def test_all_modes_equal_the_loop(spark, layers, on, mode):
    source, target = layers
    src, dst = frames(spark, source, target)
    for compare, dry_run in itertools.product((False, True), repeat=2):
        got = merge_features(src, dst, "seq", on=on, mode=mode, compare=compare, dry_run=dry_run)
        rows, counts = loop(source, target, on, mode, compare, dry_run, False)
        assert got.counts.first().asDict() == counts, (mode, compare, dry_run)
        want = sorted((tuple(r.values()) for r in target), key=repr) if dry_run else rows
        assert sorted(map(tuple, got.features.collect()), key=repr) == want


def test_hot_key_in_many_ranges(spark, layers):
    source, target = layers
    src, dst = frames(spark, source, target)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = merge_features(src, dst, "seq", on="code", compare=True)
    rows, counts = loop(source, target, "code", "default", True, False, False)
    assert got.counts.first().asDict() == counts
    assert sorted(map(tuple, got.features.collect()), key=repr) == rows
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("mode", ["default", "append_only"])
def test_preserved_fids(spark, layers, mode):
    source, target = layers
    # Source fids 25..29 and 40 are taken; their keys must still get through later.
    src, dst = frames(spark, source, target)
    rows, counts = loop(source, target, "code", mode, False, False, True)
    assert counts["failed_appends"] > 0
    with pytest.raises(ValueError, match="fid is taken"):
        merge_features(src, dst, "seq", on="code", mode=mode, preserve_fid=True)
    got = merge_features(src, dst, "seq", on="code", mode=mode, preserve_fid=True, skip_failures=True)
    assert got.counts.first().asDict() == counts
    assert got.rejects.count() == counts["failed_appends"]
    assert sorted(map(tuple, got.features.collect()), key=repr) == rows


def test_selected_fields(spark, layers):
    source, target = layers
    src, dst = frames(spark, source, target)
    got = merge_features(src, dst, "seq", on="code", mode="update_only", select=["val"], compare=True)
    rows, counts = loop(source, target, "code", "update_only", False, False, False, ["val"])
    assert got.notices == ("compare is ignored with select",)
    assert got.counts.first().asDict() == counts
    assert sorted(map(tuple, got.features.collect()), key=repr) == rows
    none = merge_features(src, dst, "seq", on="code", mode="update_only", select=[])
    assert none.counts.first().updated == counts["updated"]
    assert none.features.exceptAll(dst).count() == 0


def test_selected_values_take_the_target_type(spark):
    dst = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, 7, "c")], "fid long, n int, t string")
    src = spark.createDataFrame([(1, 1, "8", 1.5), (2, 2, "oops", 2.5), (3, 3, None, 3.5)], "fid long, seq int, n string, t double")
    options = dict(order_by="seq", mode="update_only", select=["n", "t"])
    with pytest.raises(ValueError, match="does not fit"):
        merge_features(src, dst, **options)
    got = merge_features(src, dst, **options, skip_failures=True)
    assert sorted(map(tuple, got.features.collect())) == [(1, 8, "1.5"), (2, 6, "b"), (3, None, "3.5")]
    assert got.counts.first().asDict() == dict(updated=2, appended=0, failed_updates=1, failed_appends=0)


def test_empty_layers(spark, layers):
    source, target = layers
    src, dst = frames(spark, source, target)
    nothing = merge_features(src.limit(0), dst, "seq", on="code")
    assert nothing.features.count() == len(target)
    assert nothing.counts.first().asDict() == dict(updated=0, appended=0, failed_updates=0, failed_appends=0)
    all_new = merge_features(src, dst.limit(0), "seq", on="code")
    rows, counts = loop(source, [], "code", "default", False, False, False)
    assert sorted(map(tuple, all_new.features.collect()), key=repr) == rows
    assert all_new.counts.first().asDict() == counts


def test_keys_of_other_types_meet_as_text(spark):
    dst = spark.createDataFrame([(1, "7", 0)], "fid long, code string, v int")
    src = spark.createDataFrame([(9, 1, 7, 5)], "fid long, seq int, code int, v int")
    assert merge_features(src, dst, "seq", on="code").counts.first().updated == 1


def test_layout_rules(spark):
    a = spark.createDataFrame([], "fid long, Code string, v int")
    assert comparable(a, spark.createDataFrame([], "fid long, code string, V int"))
    assert not comparable(a, spark.createDataFrame([], "fid long, v int, code string"))
    assert not comparable(a, spark.createDataFrame([], "fid long, code string, v long"))
    assert not comparable(a, spark.createDataFrame([], "fid long, code string"))
    assert field_list("a,b c") == ["a", "b c"] and field_list("a b") == ["a", "b"] and field_list("") == []
    src = spark.createDataFrame([(1, 1, 5)], "fid long, seq int, v long")
    notice = merge_features(src, spark.createDataFrame([(1, 5)], "fid long, v int"), "seq", compare=True).notices
    assert notice == ("compare is ignored: the layouts differ",)


def test_fields_only_in_the_target(spark):
    dst = spark.createDataFrame([(1, "a", 5)], "fid long, code string, extra int")
    src = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "fid long, seq int, code string")
    got = merge_features(src, dst, "seq", on="code")
    assert sorted(map(tuple, got.features.collect())) == [(1, "a", 5), (2, "b", None)]


def test_wrong_options(spark):
    a = spark.createDataFrame([], "fid long, seq int, v int")
    b = spark.createDataFrame([], "fid long, w int")
    for options in (dict(mode="all"), dict(select=["v"]), dict(on="v"), dict(on="w"), dict(on="z")):
        with pytest.raises(ValueError):
            merge_features(a, b, "seq", **options)
