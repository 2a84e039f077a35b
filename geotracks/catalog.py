"""The registered queries: every job of the package, run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from geotracks import fixtures as fx
from geotracks.functions import geometry as geo
from geotracks.functions import names
from geotracks.operators import boundaries, concave, flags, layers, lines, merge, ordering, sites
from geotracks.operators.classify import classify, new_names, track_heads
from geotracks.operators.placemarks import placemarks
from geotracks.plans import derive
from geotracks.plans.boundaries import append_boundaries, read_boundaries
from geotracks.plans.importer import Features, ImportResult, import_tracks
from geotracks.schemas import BOUNDARY_LEVELS, WGS84
from geotracks.session import materialize, work_folder
from geotracks.sources import geojson, gpx, kml, tables
from geotracks.sources.store import TrackStore
from geotracks.streaming.gpx_import import import_batch, stream_vertices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_TRACK = ["src", "ogc_fid"]
GRID_SIDE = 0.05


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _batch_no() -> Column:
    return F.col("src").cast("int").alias("batch_no")


def _rounded(column: str, digits: int = 4) -> Column:
    return F.round(column, digits).alias(column)


# --- raw tracks ---------------------------------------------------------------------------


@register
def ben_hectares(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = fx.track_vertices(spark, sf_dir)
    return derive.track_hectares(tracks).select(_batch_no(), "ogc_fid", "name", _rounded("hectares"))


@register
def classify_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = track_heads(fx.track_vertices(spark, sf_dir))
    return classify(heads).select(_batch_no(), "ogc_fid", "name", "kind", "area_id")


@register
def area_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = track_heads(fx.track_vertices(spark, sf_dir))
    return heads.where(names.is_area_name(F.col("name"))).select(_batch_no(), "ogc_fid", "name")


@register
def plot_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = track_heads(fx.track_vertices(spark, sf_dir))
    return heads.where(names.is_plot_name(F.col("name"))).select(_batch_no(), "ogc_fid", "name")


@register
def plot_area_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = track_heads(fx.track_vertices(spark, sf_dir))
    return heads.select(
        _batch_no(), "ogc_fid", "name", names.plot_area_key(F.col("name")).alias("area_key")
    )


@register
def line_merge_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = lines.merge_lines(fx.track_vertices(spark, sf_dir), _TRACK)
    counted = merged.vertices.groupBy(*_TRACK).agg(F.count("*").alias("points"))
    return (
        merged.lines.groupBy(*_TRACK)
        .agg(F.count("*").alias("lines"), F.min("closed").alias("closed"))
        .join(counted, _TRACK)
        .select(_batch_no(), "ogc_fid", "lines", "points", "closed")
    )


@register
def ring_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = lines.merge_lines(fx.track_vertices(spark, sf_dir), _TRACK)
    closed, _ = lines.close_lines(merged, _TRACK)
    return lines.ring_sums(closed, [*_TRACK, "line_no"]).select(
        _batch_no(), "ogc_fid", "points", "closed", _rounded("hectares")
    )


@register
def line_merge_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of many touching parts, one of them with a third of all events, as one line each."""
    merged = lines.merge_lines(fx.chained_vertices(spark, sf_dir), ["track"])
    ends = [F.round(F.col(c), 9).alias(c) for c in ("sx", "sy", "ex", "ey")]
    return merged.lines.select("track", "line_no", "points", *ends, "closed")


# --- areas and plots ----------------------------------------------------------------------

_states: dict[tuple[str, str], ImportResult] = {}


_staged_tracks: dict[tuple[str, str], DataFrame] = {}


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks as a stored table. Made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged_tracks:
        _staged_tracks[key] = materialize(fx.track_vertices(spark, sf_dir))
    return _staged_tracks[key]


def _import_both(spark: SparkSession, sf_dir: str, flag_between: bool = False) -> ImportResult:
    """Import batch 1, then batch 2; optionally exclude listed features in between."""
    staged = _staged(spark, sf_dir)
    first = import_tracks(staged.where("src = '1'"), store_fresh=True)
    areas, plots = first.areas, first.plots
    if flag_between:
        areas = type(areas)(
            flags.flag(areas.table, fx.exclude_areas(staged), "area_id"), areas.vertices
        )
        plots = type(plots)(
            flags.flag(plots.table, fx.exclude_plots(staged), "plot_id"), plots.vertices
        )
    second = import_tracks(staged.where("src = '2'"), areas, plots, store_fresh=True)
    rejects = first.rejects.withColumn("batch_no", F.lit(1)).unionByName(
        second.rejects.withColumn("batch_no", F.lit(2))
    )
    return replace(second, rejects=rejects)


def _stored(spark: SparkSession, sf_dir: str) -> ImportResult:
    """Both batches imported and stored: what the derivations read. Made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _states:
        result = _import_both(spark, sf_dir)
        keep = lambda f: type(f)(materialize(f.table), materialize(f.vertices))
        _states[key] = ImportResult(
            result.status,
            keep(result.areas),
            keep(result.plots),
            materialize(result.rejects),
            result.changed,
            result.fresh_vertices,
        )
    return _states[key]


def _upserted(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    features = _import_both(spark, sf_dir, flag_between=True).level(level)
    sizes = features.vertices.groupBy("fid").agg(F.count("*").alias("points"))
    return features.table.join(sizes, "fid", "left")


@register
def area_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "area")


@register
def plot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "plot")


@register
def import_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).rejects


@register
def new_names_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = classify(track_heads(fx.track_vertices(spark, sf_dir))).where("kind IS NOT NULL")
    batch = named.where("src = '2'").select("kind", "name").distinct()
    return new_names(batch, named.where("src = '1'"), ["kind", "name"])


@register
def area_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.polygon(_stored(spark, sf_dir).areas).withColumn("hectares", _rounded("hectares"))


@register
def plot_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    plots = _stored(spark, sf_dir).plots
    return derive.plot_polygon(plots).withColumn("hectares", _rounded("hectares"))


@register
def area_convex(spark: SparkSession, sf_dir: str) -> DataFrame:
    hulls = derive.convex(_stored(spark, sf_dir).areas)
    return hulls.select("fid", "area_id", "clazz", _rounded("hectares"))


@register
def plot_convex(spark: SparkSession, sf_dir: str) -> DataFrame:
    hulls = derive.convex(_stored(spark, sf_dir).plots)
    return hulls.select("fid", "area_id", "plot_id", "clazz", _rounded("hectares"))


def _concave(features: Features) -> DataFrame:
    """Hectares of the hull that keeps the whole area; points outside of a smaller hull; their order."""
    shares = {"low": 0.0, "half": 0.5, "full": 1.0}
    # Dug once, though read twice.
    rings = materialize(concave.concave_hulls(features.vertices, ["fid"], shares))
    edges = rings.select("fid", *[geo.boxed_edges(F.col(c)).alias(c) for c in ("low", "half")])
    points = features.vertices.select("fid", "x", "y").join(edges, "fid")
    kept = geo.covered(F.col("low"), F.col("x"), F.col("y")) & geo.covered(F.col("half"), F.col("x"), F.col("y"))
    outside = points.groupBy("fid").agg(F.count_if(~kept).alias("outside"))
    low, half, full = (concave.hectares(F.col(name)) for name in shares)
    shapes = rings.select("fid", F.round(full, 4).alias("hectares"), ((low <= half) & (half <= full)).alias("ordered"))
    return features.table.join(shapes, "fid", "left").join(outside, "fid", "left")


@register
def area_concave(spark: SparkSession, sf_dir: str) -> DataFrame:
    hulls = _concave(_stored(spark, sf_dir).areas)
    return hulls.select("fid", "area_id", "clazz", "hectares", "outside", "ordered")


@register
def plot_concave(spark: SparkSession, sf_dir: str) -> DataFrame:
    hulls = _concave(_stored(spark, sf_dir).plots)
    return hulls.select("fid", "area_id", "plot_id", "clazz", "hectares", "outside", "ordered")


def _edges(rings: DataFrame) -> DataFrame:
    sides = rings.select("fid", F.explode(geo.ring_edges(F.col("wkb_geometry"))).alias("side"))
    ends = {"x": "side.a.x", "y": "side.a.y", "next_x": "side.b.x", "next_y": "side.b.y"}
    named = sides.select("fid", *[F.round(c, 9).alias(n) for n, c in ends.items()])
    return named.where("x <> next_x OR y <> next_y")


@register
def area_convex_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(derive.convex(_stored(spark, sf_dir).areas))


@register
def plot_convex_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(derive.convex(_stored(spark, sf_dir).plots))


@register
def area_polygon_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.polygon_vertices(_stored(spark, sf_dir).areas)


@register
def plot_polygon_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.polygon_vertices(_stored(spark, sf_dir).plots)


@register
def flag_plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = fx.exclude_plots(_staged(spark, sf_dir))
    return flags.flag(_stored(spark, sf_dir).plots.table, ids, "plot_id")


@register
def flag_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = fx.exclude_areas(_staged(spark, sf_dir))
    return flags.flag(_stored(spark, sf_dir).areas.table, ids, "area_id")


@register
def flag_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey's own lists on parcels named after the customers' numbers."""
    named = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("fid"),
        F.concat(F.lit("GOR-4-2-"), F.col("c_custkey") % 9).alias("area_id"),
        F.concat(F.lit("SAK-1-4-1-"), F.col("c_custkey") % 15).alias("plot_id"),
        F.lit(0).alias("clazz"),
    )
    return flags.flag(flags.flag(named, flags.EXCLUDED_PLOTS, "plot_id"), flags.EXCLUDED_AREAS, "area_id", 2)


@register
def area_plot_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir)
    both = derive.reconcile(derive.convex(stored.areas), derive.convex(stored.plots))
    return both.select(
        "area_id", _rounded("hectares", 3), _rounded("plot_sum", 3), _rounded("difference", 3)
    )


@register
def track_import_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    vertices = fx.track_vertices(spark, sf_dir)
    vertices.write.mode("overwrite").parquet(f"{run}/landing")
    store = TrackStore(spark, f"{run}/store")
    stream_vertices(spark, f"{run}/landing", store, f"{run}/offsets").awaitTermination()
    areas, plots = store.features("area").table, store.features("plot").table
    return areas.select(F.lit("area").alias("kind"), "fid", F.col("area_id").alias("name")).unionByName(
        plots.select(F.lit("plot").alias("kind"), "fid", F.col("plot_id").alias("name"))
    )


@register
def track_import_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks whose vertices come in two runs of the stream, held until they are whole."""
    run = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    vertices = materialize(fx.track_vertices(spark, sf_dir))
    sizes = vertices.groupBy("src", "ogc_fid").agg(F.count_distinct("seg_no").cast("int").alias("parts"), F.count("*").alias("points"))
    sizes.write.parquet(f"{run}/totals")
    store = TrackStore(spark, f"{run}/store")
    for part in (vertices.where("pt_no = 1"), vertices.where("pt_no > 1")):
        part.write.mode("append").parquet(f"{run}/landing")
        stream_vertices(spark, f"{run}/landing", store, f"{run}/offsets", totals=f"{run}/totals").awaitTermination()
    found = []
    for kind, key in (("area", "area_id"), ("plot", "plot_id")):
        features = store.features(kind)
        sizes = features.vertices.groupBy("fid").agg(F.count("*").alias("points"))
        named = features.table.join(sizes, "fid", "left").select(F.lit(kind).alias("kind"), F.col(key).alias("name"), F.coalesce("points", F.lit(0)).alias("points"))
        found.append(named)
    return found[0].unionByName(found[1])


@register
def stored_area_convex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches committed to a store, its area derivations refreshed, one read back."""
    store = TrackStore(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    staged = _staged(spark, sf_dir)
    for src in ("1", "2"):
        import_batch(store, staged.where(F.col("src") == src), label=src)
    store.refresh("area")
    return store.derived("area", "convex").select("fid", "area_id", "clazz", _rounded("hectares"))


@register
def store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches committed, the store compacted and cleaned, its areas read back with their sizes."""
    store = TrackStore(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    staged = _staged(spark, sf_dir)
    for number, src in enumerate(("1", "2", "1", "2")):
        import_batch(store, staged.where(F.col("src") == src), label=str(number))
    store.compact()
    store.vacuum()
    features = store.features("area")
    sizes = features.vertices.groupBy("fid").agg(F.count("*").alias("points"))
    return features.table.join(sizes, "fid", "left")


# --- short lines: blocks of consecutive events, at most BLOCK points each -------------------

BLOCK = 20


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per block of event ids, with its points in order: never more than BLOCK."""
    events = fx.table(spark, sf_dir, "events").selectExpr(*fx.EVENT_POINT_COLUMNS)
    point = F.struct("event_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return (
        events.groupBy(F.floor(F.col("event_id") / BLOCK).alias("block"))
        .agg(F.array_sort(F.collect_list(point)).alias("pts"))
        .select(
            "block",
            F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pts"),
        )
    )


@register
def line_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column builders on lines of two parts, which touch in every other block."""
    half = F.floor(F.size("pts") / 2).cast("int")
    second = F.when(F.col("block") % 2 == 0, F.greatest(half, F.lit(1))).otherwise(half + 1)
    parts = F.array(
        F.slice("pts", F.lit(1), half), F.slice("pts", second, F.size("pts"))
    )
    merged = _blocks(spark, sf_dir).select("block", "pts", geo.line_merge(parts).alias("lines"))
    closed = merged.withColumn("ring", geo.make_polygon(geo.close_ring(F.col("lines"))))
    return closed.select(
        "block",
        F.size("lines").alias("lines"),
        geo.is_closed(F.col("lines")).alias("closed"),
        F.round(geo.start_point(F.col("lines"))["x"], 9).alias("start_x"),
        F.when(F.col("ring").isNotNull(), F.size("ring")).alias("ring_points"),
        F.round(geo.ring_hectares(F.col("ring")), 2).alias("hectares"),
        F.round(geo.ring_hectares(geo.convex_hull(F.col("pts"))), 2).alias("hull_hectares"),
    )


@register
def gpx_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written as GPX tracks, and read back as vertices."""
    path = f"{work_folder(spark)}/gpx-{uuid.uuid4().hex}"
    point = lambda p: F.struct(p["y"].alias("_lat"), p["x"].alias("_lon"))
    tracks = _blocks(spark, sf_dir).select(
        F.concat(F.lit("BLK-0-0-"), F.col("block")).alias("name"),
        F.array(F.struct(F.transform("pts", point).alias("trkpt"))).alias("trkseg"),
    )
    xml = tracks.write.format("xml").option("rootTag", "gpx").option("rowTag", "trk")
    xml.save(path)
    vertices, _ = gpx.read_gpx(spark, f"{path}/*.xml")
    return vertices.select("name", "seg_no", "pt_no", "x", "y")


# --- keys, order, layers ------------------------------------------------------------------


@register
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return ordering.assign_fid(orders, ["o_orderdate", "o_orderkey"], start=1000)


@register
def feature_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.feature_at(fx.merge_target(spark, sf_dir), ["fid"], 7)


@register
def first_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.first_features(fx.merge_target(spark, sf_dir), ["fid"], 5)


@register
def layer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.count_features(fx.track_vertices(spark, sf_dir))


@register
def layer_srid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.srid_of(fx.boundaries(spark, sf_dir))


@register
def layer_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bounds(fx.track_vertices(spark, sf_dir))


@register
def grid_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = layers.bounds(fx.track_vertices(spark, sf_dir))
    frame = layers.grid_envelope(box, GRID_SIDE)
    return frame.select(
        "nx", "ny", *[_rounded(c, 9) for c in ("minx", "miny", "maxx", "maxy")]
    )


@register
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = layers.square_grid(layers.bounds(fx.track_vertices(spark, sf_dir)), GRID_SIDE)
    return cells.select(
        "cell_id", "col", "row", *[_rounded(c, 9) for c in ("minx", "miny", "maxx", "maxy")],
        F.size("wkb_geometry").alias("points"),
    )


@register
def mercator_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = fx.track_vertices(spark, sf_dir)
    return tracks.select(
        _batch_no(), "ogc_fid", "seg_no", "pt_no",
        F.round(geo.mercator_x(F.col("x")), 3).alias("mx"),
        F.round(geo.mercator_y(F.col("y")), 3).alias("my"),
    )


# --- tables -------------------------------------------------------------------------------


@register
def opened_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view on a layer, opened by the name of the layer it is to be merged with."""
    name = f"layer_{uuid.uuid4().hex}"
    tables.create_view(fx.merge_target(spark, sf_dir), name)
    return tables.open_layer(spark, ["other", name], like=name)


@register
def table_from_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"counts_{uuid.uuid4().hex}"
    counts = fx.merge_target(spark, sf_dir).groupBy("cat").agg(F.count("*").alias("features"), F.max("fid").alias("last_fid"))
    tables.create_table(counts, name, f"{work_folder(spark)}/{name}")
    return tables.open_layer(spark, [name])


@register
def project_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.merge_target(spark, sf_dir).select(*merge.field_list("code,val"))


@register
def merge_layouts_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparing is switched off, with a notice, where the layers have other fields."""
    target = fx.merge_target(spark, sf_dir).withColumn("more", F.lit(1))
    merged = merge.merge_features(fx.merge_source(spark, sf_dir), target, order_by="seq", on="code", compare=True)
    return merged.counts.select(F.lit("; ".join(merged.notices)).alias("notice"), "updated", "appended")


@register
def import_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an import says of all tracks, and of none."""
    tracks = materialize(fx.track_vertices(spark, sf_dir))
    done = []
    for label, part in (("whole", tracks), ("nothing", tracks.limit(0))):
        result = import_tracks(part)
        names = sum(result.level(level).table.count() for level in ("area", "plot"))
        done.append((label, result.status, names))
    return spark.createDataFrame(done, "input string, status boolean, names long")


# --- feature merge ------------------------------------------------------------------------


def _merge(spark: SparkSession, sf_dir: str, **options) -> merge.MergeResult:
    return merge.merge_features(
        fx.merge_source(spark, sf_dir), fx.merge_target(spark, sf_dir), order_by="seq", **options
    )


def _merge_counts(spark: SparkSession, sf_dir: str, runs: list[dict]) -> DataFrame:
    counted = [
        _merge(spark, sf_dir, on="code", **run).counts.select(
            F.lit(run["mode"]).alias("mode"),
            F.lit(run.get("compare", False)).alias("compare"),
            "updated",
            "appended",
        )
        for run in runs
    ]
    return reduce(DataFrame.unionByName, counted)


@register
def merge_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir).features


@register
def merge_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code").features


@register
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code", mode="update_only").features


@register
def merge_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code", mode="append_only").features


@register
def merge_selected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code", mode="update_only", select=["val"]).features


@register
def merge_preserve_fid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code", preserve_fid=True, skip_failures=True).features


@register
def merge_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, on="code", preserve_fid=True, skip_failures=True).rejects


@register
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_counts(spark, sf_dir, [{"mode": m} for m in merge.MODES])


@register
def merge_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_counts(spark, sf_dir, [{"mode": m, "compare": True} for m in merge.MODES])


@register
def merge_dry_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = [{"mode": m, "dry_run": True, "compare": c} for m in merge.MODES for c in (False, True)]
    return _merge_counts(spark, sf_dir, runs)


def _with_geometry(layer: DataFrame) -> DataFrame:
    return layer.withColumn("geometry", geo.make_point(F.col("x"), F.col("y"))).drop("x", "y")


def _merge_geometry(spark: SparkSession, sf_dir: str, **options) -> merge.MergeResult:
    """Point features merged on a number that many of them share."""
    source, target = fx.merge_source(spark, sf_dir), fx.merge_target(spark, sf_dir)
    return merge.merge_features(_with_geometry(source), _with_geometry(target), order_by="seq", on="cat", **options)


@register
def merge_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merge_geometry(spark, sf_dir).features
    return merged.select("fid", "code", "label", "val", "cat", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


@register
def merge_geometry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = [{"compare": c, "dry_run": d} for c in (False, True) for d in (False, True)]
    counted = [
        _merge_geometry(spark, sf_dir, **run).counts.select(
            F.lit(run["compare"]).alias("compare"), F.lit(run["dry_run"]).alias("dry_run"), "updated", "appended"
        )
        for run in runs
    ]
    return reduce(DataFrame.unionByName, counted)


@register
def same_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of the first batch against a copy: one of them turned round, one moved, one without its line."""
    tracks = fx.track_vertices(spark, sf_dir).where("src = '1'")
    here = materialize(tracks.select(F.col("ogc_fid").alias("fid"), F.col("seg_no").alias("line_no"), "pt_no", "x", "y"))
    last = here.groupBy("fid", "line_no").agg(F.max("pt_no").alias("last"))
    turned = F.when(F.col("fid") % 3 == 0, F.col("last") + 1 - F.col("pt_no")).otherwise(F.col("pt_no"))
    moved = F.when((F.col("fid") % 5 == 0) & (F.col("pt_no") == 1), F.col("x") + 1e-7).otherwise(F.col("x"))
    there = here.join(last, ["fid", "line_no"]).where("fid % 7 <> 0").select("fid", "line_no", turned.alias("pt_no"), moved.alias("x"), "y")
    pairs = here.select(F.col("fid").alias("fid_a"), F.col("fid").alias("fid_b")).distinct()
    return lines.same_geometries(here, there, pairs)


# --- sites and boundaries -----------------------------------------------------------------


@register
def sites_drop_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.drop_header_rows(fx.sites(spark, sf_dir))


@register
def sites_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site rows written as headerless CSV, and read back; empty text comes back as null."""
    path = f"{work_folder(spark)}/sites-{uuid.uuid4().hex}"
    fx.sites(spark, sf_dir).write.csv(path, emptyValue="", nullValue="")
    return sites.drop_header_rows(tables.read_sites(spark, path))


@register
def sites_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = sites.site_points(fx.sites(spark, sf_dir))
    return points.select(
        *[c for c in points.columns if c != "the_geom"],
        F.col("the_geom.x").alias("x"),
        F.col("the_geom.y").alias("y"),
        geo.set_srid(4326).alias("srid"),
    )


def _boundary_columns(df: DataFrame) -> DataFrame:
    # Decimals as doubles: the same number on every engine.
    numbers = ("str_year", "exp_year", "adm0_code", "shape_leng", "shape_area")
    points = F.flatten(F.flatten("wkb_geometry"))
    corner = lambda pick, c: pick(F.transform(points, lambda p: p[c]))
    return df.select(
        *[F.col(c).cast("double").alias(c) if c in numbers else c for c in df.columns if c != "wkb_geometry"],
        corner(F.array_min, "x").alias("minx"), corner(F.array_min, "y").alias("miny"),
        corner(F.array_max, "x").alias("maxx"), corner(F.array_max, "y").alias("maxy"),
    )


@register
def boundary_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = boundaries.load_boundaries(fx.boundaries(spark, sf_dir), 0)
    return _boundary_columns(accepted)


@register
def boundary_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = boundaries.load_boundaries(fx.boundaries(spark, sf_dir), 0)
    return rejected


@register
def boundary_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all three levels, each loaded twice: ids of the first load stay taken."""
    base = f"{work_folder(spark)}/boundaries-{uuid.uuid4().hex}"
    raw = fx.boundaries(spark, sf_dir)
    stored = []
    for level in BOUNDARY_LEVELS:
        for shift in (0, 10):
            append_boundaries(raw.withColumn("ogc_fid", F.col("ogc_fid") + shift), level, base)
        stored.append(_boundary_columns(read_boundaries(spark, level, base)).withColumn("level", F.lit(level)))
    return reduce(DataFrame.unionByName, stored).select("level", "ogc_fid", "adm0_name", "adm0_code", "minx")


def _corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corners of the boundaries that can be loaded, with their reference system."""
    accepted, _ = boundaries.load_boundaries(fx.boundaries(spark, sf_dir), 0)
    point = F.explode(F.flatten(F.flatten("wkb_geometry")))
    return accepted.select(point.alias("p"), geo.set_srid(WGS84).alias("srid")).select("p.x", "p.y", "srid")


@register
def layer_bounds_srid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bounds(_corners(spark, sf_dir))


@register
def layer_grid_srid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = layers.square_grid(layers.bounds(_corners(spark, sf_dir)), 0.75)
    return cells.select("cell_id", _rounded("minx", 9), _rounded("miny", 9), "srid")


@register
def boundary_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = boundaries.load_boundaries(fx.boundaries(spark, sf_dir), 0)
    return _boundary_columns(layers.where_equals(accepted, "adm0_code", 6))


@register
def boundary_hectares(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [F.col(c) for c in ("minx", "miny", "maxx", "maxy")]
    raw = fx.boundaries(spark, sf_dir).withColumn("ring", geo.square(*box))
    return raw.select("ogc_fid", F.round(geo.ring_hectares(F.col("ring")), 3).alias("hectares"))


# --- reports and exchange -----------------------------------------------------------------


def _point_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fx.merge_target(spark, sf_dir)
    return target.select(
        "fid", "code", "label", F.col("cat"), geo.make_point(F.col("x"), F.col("y")).alias("geometry")
    )


@register
def placemark_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placemarks(_point_features(spark, sf_dir), ["fid"])


def _many_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    at = geo.make_point((F.col("o_custkey") % 360 - 180).cast("double"), (F.col("o_orderkey") % 180 - 90).cast("double"))
    return orders.select(F.col("o_orderkey").alias("fid"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"), at.alias("geometry"))


@register
def geojson_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a new table, its fields those of the first feature."""
    run = f"{work_folder(spark)}/geojson-{uuid.uuid4().hex}"
    _write_geojson(_point_features(spark, sf_dir), f"{run}/in")
    name = f"features_{uuid.uuid4().hex}"
    geojson.geojson_to_table(spark, f"{run}/in", name, lines=True, path=f"{run}/table")
    point = geojson.geometry_of(F.col("coordinates"), "Point")
    return spark.table(name).select("fid", "code", "label", "cat", point["x"].alias("x"), point["y"].alias("y"))


@register
def kml_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one report document, written in parts and read back."""
    path = f"{work_folder(spark)}/report-{uuid.uuid4().hex}"
    kml.write_kml(placemarks(_many_points(spark, sf_dir), ["fid"]), path)
    return kml.read_kml(spark, path)


@register
def kml_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as one file: its folders, and what its one folder holds."""
    path = f"{work_folder(spark)}/report-{uuid.uuid4().hex}.kml"
    kml.write_kml(placemarks(_point_features(spark, sf_dir), ["fid"]), path, join=True)
    folder = "name string, Style array<struct<_id:string>>, StyleMap struct<_id:string>, Placemark array<struct<name:string,Point:struct<coordinates:string>>>"
    folders = spark.read.format("xml").option("rowTag", "Folder").schema(folder).load(path)
    return folders.select(
        "name", F.size("Style").alias("styles"), F.col("StyleMap._id").alias("style_map"), F.size("Placemark").alias("placemarks"),
        F.element_at("Placemark", 1)["name"].alias("first_name"), F.element_at("Placemark", -1)["Point"]["coordinates"].alias("last_coordinates"),
    )


def _write_geojson(points: DataFrame, path: str) -> DataFrame:
    """Points written as newline-delimited features; returns these."""
    rest = [c for c in points.columns if c != "geometry"]
    at = F.struct(F.lit("Point").alias("type"), F.array("geometry.x", "geometry.y").alias("coordinates"))
    features = points.select(F.struct(*rest).alias("properties"), at.alias("geometry"))
    features.write.mode("overwrite").json(path)
    return features


@register
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier points written as newline-delimited GeoJSON, and read back."""
    path = f"{work_folder(spark)}/geojson-{uuid.uuid4().hex}"
    features = _write_geojson(_point_features(spark, sf_dir), path)
    read = geojson.read_geojson(spark, path, features.schema["properties"].dataType, lines=True)
    return geojson.with_geometry(read, "Point").select(
        "fid", "code", "label", "cat", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y")
    )


@register
def layer_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer written, appended to, and replaced by what is read from it."""
    path = f"{work_folder(spark)}/layer-{uuid.uuid4().hex}"
    target = fx.merge_target(spark, sf_dir)
    tables.write_layer(target, path)
    tables.write_layer(target.withColumn("fid", F.col("fid") + 5_000_000), path, "append")
    tables.write_layer(tables.read_layer(spark, path).withColumn("val", F.col("val") * 2), path)
    tables.vacuum_layer(spark, path)
    return tables.read_layer(spark, path)


@register
def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fx.merge_source(spark, sf_dir).drop("label")
    return tables.append_by_name(source, fx.merge_target(spark, sf_dir))
