"""Files in and out: GPX, CSV, GeoJSON, KML, tables, the store and the stream."""

import json
import re
import uuid

import pytest
from conftest import SMALL, vertices
from pyspark.sql import functions as F, types as T

from geotracks import fixtures as fx
from geotracks.functions import geometry as geo
from geotracks.operators import boundaries, layers, sites
from geotracks.operators.placemarks import placemarks
from geotracks.plans.boundaries import append_boundaries, read_boundaries
from geotracks.plans.importer import import_tracks
from geotracks.schemas import TRACK_VERTICES
from geotracks.sources import geojson, gpx, kml, tables
from geotracks.sources.store import TrackStore
from geotracks.streaming.gpx_import import held_tracks, import_batch, query_id, stream_gpx, stream_vertices

RING = [(2.0, 9.0), (2.1, 9.0), (2.1, 9.1), (2.0, 9.0)]


def gpx_text(tracks):
    body = ""
    for name, parts in tracks:
        segs = "".join(
            "<trkseg>" + "".join(f'<trkpt lat="{y}" lon="{x}"><ele>3</ele></trkpt>' for x, y in p) + "</trkseg>"
            for p in parts
        )
        body += f"<trk><name>{name}</name>{segs}</trk>"
    return (
        '<?xml version="1.0"?><gpx xmlns="http://www.topografix.com/GPX/1/1" version="1.1">'
        f'<metadata><name>m</name></metadata><wpt lat="1" lon="1"><name>AAA-9-9-9</name></wpt>{body}</gpx>'
    )


def test_read_gpx(spark, tmp_path):
    (tmp_path / "a.gpx").write_text(gpx_text([("AAA-1-1-1", [RING[:2], [], RING[1:]]), ("AAA-1-1-2", [RING])]))
    (tmp_path / "b.gpx").write_text(gpx_text([("AAA-1-1-1-1", [RING])]))
    (tmp_path / "broken.gpx").write_text(gpx_text([("AAA-3-3-3", [RING]), ("AAA-3-3-4", [RING])])[:-60])
    cut = gpx_text([("AAA-4-4-4", [RING]), ("AAA-4-4-5", [RING])])
    (tmp_path / "cut [1] between.gpx").write_text(cut[: cut.index("</trk>") + len("</trk>")])
    (tmp_path / "garbage.gpx").write_text("no markup at all")
    got, rejects = gpx.read_gpx(spark, f"{tmp_path}/*.gpx")
    rows = got.orderBy("src", "ogc_fid", "seg_no", "pt_no").collect()
    assert {r.name for r in rows} == {"AAA-1-1-1", "AAA-1-1-2", "AAA-1-1-1-1"}
    first = [(r.seg_no, r.pt_no, r.x, r.y) for r in rows if r.name == "AAA-1-1-1"]
    assert first == [(0, 1, 2.0, 9.0), (0, 2, 2.1, 9.0), (1, 1, 2.1, 9.0), (1, 2, 2.1, 9.1), (1, 3, 2.0, 9.0)]
    fids = [r.ogc_fid for r in rows if r.src.endswith("a.gpx")]
    assert fids == sorted(fids) and len(set(fids)) == 2
    assert sorted(r.src.rsplit("/", 1)[1] for r in rejects.collect()) == ["broken.gpx", "cut%20%5B1%5D%20between.gpx", "garbage.gpx"]


def test_stream_of_cut_tracks(spark, tmp_path):
    """A track whose other vertices come in a later batch does not replace what is stored."""
    landing, store = str(tmp_path / "landing"), TrackStore(spark, f"{tmp_path}/store")
    rows = [("s", 1, "AAA-1-1-1", 0, i + 1, x, y) for i, (x, y) in enumerate(RING + [(1.9, 8.9), (2.0, 9.0)])]
    other = [("s", 2, "AAA-1-1-2", 0, i + 1, x, y) for i, (x, y) in enumerate(RING)]
    for part in (rows[:3], rows[3:] + other):
        spark.createDataFrame(part, TRACK_VERTICES).write.mode("append").parquet(landing)
        stream_vertices(spark, landing, store, f"{tmp_path}/offsets").awaitTermination()
    areas = store.features("area")
    assert {r.area_id for r in areas.table.collect()} == {"AAA-1-1-1", "AAA-1-1-2"}
    fid = next(r.fid for r in areas.table.collect() if r.area_id == "AAA-1-1-1")
    got = areas.vertices.where(F.col("fid") == fid).orderBy("pt_no").select("x", "y").collect()
    assert [tuple(r) for r in got][:3] == RING[:3]
    broken = spark.read.parquet(f"{tmp_path}/store/broken_tracks").select("src", "ogc_fid").collect()
    assert [tuple(r) for r in broken] == [("s", 1)]


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.gpx").write_text(gpx_text([("AAA-1-1-1", [RING]), ("AAA-1-1-1-1", [RING])]))
    (landing / "2.gpx").write_text(gpx_text([("AAA-1-1-1", [RING[:3]]), ("AAA-0-1-1", [RING])]))
    (landing / "3.gpx").write_text(gpx_text([("ZZZ-1-1-1", [RING])])[:-50])
    store = TrackStore(spark, f"{tmp_path}/store")
    assert store.version() is None and store.features("area") is None and not store.refresh()
    stream_gpx(spark, str(landing), store, f"{tmp_path}/offsets").awaitTermination()
    batch = import_tracks(gpx.read_gpx(spark, f"{landing}/*.gpx")[0])
    assert sorted(map(tuple, store.features("area").table.collect())) == sorted(map(tuple, batch.areas.table.collect()))
    assert store.features("area").vertices.exceptAll(batch.areas.vertices).count() == 0

    # A later file is a later batch.
    (landing / "4.gpx").write_text(gpx_text([("AAA-1-1-1", [RING + [(1.9, 8.9), (2.0, 9.0)]])]))
    stream_gpx(spark, str(landing), store, f"{tmp_path}/offsets").awaitTermination()
    areas = {r.area_id: r.fid for r in store.features("area").table.collect()}
    assert areas == {"AAA-0-1-1": 1, "AAA-1-1-1": 2}
    sizes = {r.fid: r["count"] for r in store.features("area").vertices.groupBy("fid").count().collect()}
    assert sizes == {1: 4, 2: 6}

    # A replayed batch changes nothing.
    version = store.version()
    stream = query_id(spark, f"{tmp_path}/offsets")
    assert store.has_batch(f"{stream} {version}")
    assert not import_batch(store, batch.areas.vertices, f"{stream} {version}")
    assert store.version() == version

    # A new checkpoint folder is another stream: its batch 0 is imported, and lists its files.
    stream_gpx(spark, str(landing), store, f"{tmp_path}/new_offsets").awaitTermination()
    assert store.version() == version + 1 and query_id(spark, f"{tmp_path}/new_offsets") != stream
    assert len(list((tmp_path / "store" / "broken_files").glob("query=*/batch=0"))) == 2

    assert store.refresh()
    assert store.derived("area", "convex").count() == 2
    assert store.derived("plot", "polygon").columns[:4] == ["fid", "plot_id", "area_id", "clazz"]
    with pytest.raises(ValueError):
        store.derived("area", "other")


def test_refresh_one_level(spark, tmp_path):
    store = TrackStore(spark, f"{tmp_path}/store")
    assert import_batch(store, vertices(spark, [("AAA-1-1-1", [RING])]))
    assert store.refresh("area") and store.refresh("area") and store.derived("area", "concave").count() == 1
    with pytest.raises(ValueError):
        store.derived("plot", "concave")
    # Nothing to import: no new version.
    assert not import_batch(store, vertices(spark, [("AAA-1-1-1", [RING])]).limit(0))
    assert store.version() == 0
    assert import_batch(store, vertices(spark, [("AAA-1-1-1", [RING[:3]]), ("AAA-2-1-1", [RING])]))
    assert store.version() == 1 and store.features("area").table.count() == 2


def test_sites_from_csv(spark, tmp_path):
    header = ",".join(n for n in "store_name site_name site_number latitude longitude altitude gatewidth ownername comments countrygeofeature_id adm1geofeature_id adm2geofeature_id".split())
    lines = [header, "a,s1,1,9.5,-2.25,,,o,,1,2,3", "b,s2,2,,-2,,,o,,1,2,3", 'c,s3,3,"",1,,,o,,1,2,3', ",s4,4,1e1,+.5,,,o,,1,2,3", "d,s5,5,1.0d,2,,,o,,1,2,3"]
    (tmp_path / "sites.csv").write_text("\n".join(lines))
    rows = tables.read_sites(spark, f"{tmp_path}/sites.csv")
    assert rows.count() == 6
    got = sites.site_points(rows, permissive=True)
    assert len(got.columns) == 11 and got.columns[3] == "the_geom"
    assert {r.site_name: r.the_geom and tuple(r.the_geom) for r in got.collect()} == {"s1": (-2.25, 9.5), "s4": (0.5, 10.0), "s5": None}
    with pytest.raises(Exception, match="not a number"):
        sites.site_points(rows).collect()
    assert sites.site_points(rows.where("site_name <> 's5'")).count() == 2


def test_boundaries(spark):
    raw = fx.boundaries(spark, SMALL)
    accepted, _ = boundaries.load_boundaries(raw, 1)
    more = raw.where("ogc_fid <= 2").withColumn("status", F.lit("x" * 38))
    twice = raw.unionByName(raw.where("ogc_fid = 1").withColumn("status", F.lit("A")))
    twice = twice.unionByName(more.withColumn("ogc_fid", F.col("ogc_fid") + 500))
    twice = twice.unionByName(raw.where("ogc_fid = 1").withColumns({"ogc_fid": F.lit(900), "str_year": F.lit("12345678901")}))
    got, rejected = boundaries.load_boundaries(twice, 2)
    assert got.count() == accepted.count()
    assert got.where("ogc_fid = 1").first().status == "A"
    reasons = {(r.ogc_fid, r.reason): r.features for r in rejected.collect()}
    assert reasons[(1, "repeated ogc_fid")] == 1
    assert reasons[(501, "status")] == reasons[(502, "status")] == reasons[(900, "str_year")] == 1
    again, clash = boundaries.load_boundaries(raw, 0, existing=accepted)
    assert again.count() == 0 and clash.where("reason = 'repeated ogc_fid'").count() == accepted.count()
    assert boundaries.table_name(2) == "g2013_2012_2"
    with pytest.raises(ValueError):
        boundaries.load_boundaries(raw, 3)


def collection(features):
    return json.dumps({"type": "FeatureCollection", "features": features})


def feature(geometry, **properties):
    return {"type": "Feature", "properties": properties, "geometry": geometry}


def test_geojson(spark, tmp_path):
    path = f"{tmp_path}/c.json"
    (tmp_path / "c.json").write_text(
        collection(
            [
                feature({"type": "Point", "coordinates": [1.5, 2.5]}, name="a", n=1),
                feature({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}, name="b", n=2),
                feature(None, name="c", n=None),
            ]
        )
    )
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
    for given in (schema, None):
        got = geojson.read_geojson(spark, path, given)
        assert set(got.columns) == {"name", "n", "geom_type", "coordinates"} and got.count() == 3
        points = geojson.with_geometry(got, "Point").collect()
        assert [(r.name, r.n, tuple(r.geometry)) for r in points] == [("a", 1, (1.5, 2.5))]
        (area,) = geojson.with_geometry(got, "MultiPolygon").collect()
        assert [tuple(p) for p in area.geometry[0][0]] == [(0, 0), (1, 0), (1, 1), (0, 0)]
    (tmp_path / "empty.json").write_text(collection([]))
    assert geojson.read_geojson(spark, f"{tmp_path}/empty.json", schema) is None
    assert geojson.read_geojson(spark, f"{tmp_path}/empty.json") is None


def test_append_by_name(spark):
    target = spark.createDataFrame([("a", 1, 2.0)], "name string, n int, z double")
    got = tables.append_by_name(spark.createDataFrame([(7, "b", "x")], "N long, name string, other string"), target)
    assert sorted(map(tuple, got.collect())) == [("a", 1, 2.0), ("b", 7, None)]


def test_placemarks_and_kml(spark, tmp_path):
    df = spark.createDataFrame([(2, "b & <c>", 3.5, 4.5), (1, None, 1.25, None)], "id int, label string, x double, y double")
    points = df.select("id", "label", geo.make_point(F.col("x"), F.col("y")).alias("geometry"))
    rows = placemarks(points, ["id"]).orderBy("idx").collect()
    assert [(r.idx, r.name, r.coordinates) for r in rows] == [(1, "Feature_1", "0,0,0"), (2, "Feature_2", "4.5,3.5")]
    assert "Property <b>label</b> has value <b></b>" in rows[0].description
    assert "Property <b>geometry</b> has value <b>POINT (3.5 4.5)</b>" in rows[1].description
    assert placemarks(points, ["id"], axis_order="xy").where("idx = 2").first().coordinates == "3.5,4.5"
    other = df.select("id", F.array("x").alias("geometry"))
    assert {r.coordinates for r in placemarks(other, ["id"]).collect()} == {"0,0,0"}
    with pytest.raises(ValueError):
        placemarks(points, ["id"], axis_order="zz")

    kml.write_kml(placemarks(points, ["id"]), f"{tmp_path}/report.kml", join=True)
    text = (tmp_path / "report.kml").read_text()
    assert text.count("<Placemark>") == 2 and text.count("<Folder>") == 1
    assert not (tmp_path / "report.kml.parts").exists()
    assert re.search(r'<kml xmlns="http://earth.google.com/kml/2.0">', text) and text.rstrip().endswith("</kml>")
    assert '<Style id="highlightPlacemark">' in text and '<StyleMap id="exampleStyleMap">' in text
    import xml.etree.ElementTree as ET

    root = ET.fromstring(text)
    space = "{http://earth.google.com/kml/2.0}"
    marks = list(root.iter(f"{space}Placemark"))
    assert [m.find(f"{space}name").text for m in marks] == ["Feature_1", "Feature_2"]
    assert "b & <c>" in marks[1].find(f"{space}description").text
    assert marks[1].find(f"{space}Point/{space}coordinates").text == "4.5,3.5"


def test_create_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "fid long, name string")
    name = f"made_{uuid.uuid4().hex[:8]}"
    tables.create_table(df, name, path=f"{tmp_path}/t")
    assert spark.table(name).schema == df.schema and spark.table(name).count() == 1
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.create_table(df, name, path=f"{tmp_path}/t")


def test_layers_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "fid long, adm0_code int")
    name = f"layer_{uuid.uuid4().hex[:8]}"
    tables.create_view(df, name)
    assert tables.open_layer(spark, [name]).count() == 3
    assert tables.open_layer(spark, ["other", name], name=name).count() == 3
    assert tables.open_layer(spark, ["other", name], like=name).count() == 3
    for bad in (dict(layers=["a", "b"]), dict(layers=["a", "b"], name="c"), dict(layers=["a", "b"], like="c")):
        with pytest.raises(ValueError):
            tables.open_layer(spark, **bad)
    assert [r.fid for r in layers.where_equals(df, "adm0_code", 5).collect()] == [1]
    tables.write_layer(layers.where_equals(df, "adm0_code", 5), f"{tmp_path}/out")
    assert tables.read_layer(spark, f"{tmp_path}/out").count() == 1
    with pytest.raises(Exception):
        layers.where_equals(df, "no_field", 5)


@pytest.mark.parametrize(
    "width, height, side, nx, ny", [(10, 5, 2, 6, 3), (0, 0, 1, 1, 1), (7, 1, 2.5, 3, 1), (4, 4, 4, 2, 2)]
)
def test_grid(spark, width, height, side, nx, ny):
    points = spark.createDataFrame([(10.0, 20.0), (10.0 + width, 20.0 + height)], "x double, y double")
    box = layers.bounds(points)
    frame = layers.grid_envelope(box, side).first()
    assert (frame.nx, frame.ny) == (nx, ny)
    assert abs((frame.minx + frame.maxx) / 2 - (10 + width / 2)) < 1e-9
    cells = layers.square_grid(box, side)
    assert cells.count() == nx * ny
    first = cells.where("cell_id = 1").first()
    assert (first.minx, first.miny) == (frame.minx, frame.miny)
    assert cells.agg(F.max("maxx")).first()[0] == pytest.approx(frame.maxx)
    assert cells.agg(F.sum(geo.ring_area(F.col("wkb_geometry")))).first()[0] == pytest.approx(nx * ny * side**2)


def test_grid_of_nothing(spark):
    empty = layers.bounds(spark.createDataFrame([], "x double, y double"))
    assert layers.square_grid(empty, 1.0).count() == 0
    with pytest.raises(ValueError):
        layers.grid_envelope(empty, 0)


def test_a_write_that_fails_leaves_the_layer(spark, tmp_path):
    path = f"{tmp_path}/layer"
    with pytest.raises(ValueError, match="no layer"):
        tables.read_layer(spark, path)
    first = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    tables.write_layer(first, path)
    broken = F.when(F.col("id") == 77, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            tables.write_layer(first.repartition(8).withColumn("v", broken), path, mode)
        assert tables.read_layer(spark, path).exceptAll(first).count() == 0 and tables.read_layer(spark, path).count() == 100
    tables.write_layer(tables.read_layer(spark, path).where("id < 10"), path)
    tables.write_layer(first.where("id >= 90"), path, "append")
    assert sorted(r.id for r in tables.read_layer(spark, path).collect()) == [*range(10), *range(90, 100)]
    tables.write_layer(first, path, "ignore")
    with pytest.raises(ValueError, match="there is a layer"):
        tables.write_layer(first, path, "error")
    with pytest.raises(ValueError, match="cannot be appended"):
        tables.write_layer(first.select("id"), path, "append")
    # the first version and what the two failed writes left
    assert tables.vacuum_layer(spark, path) >= 1
    assert tables.read_layer(spark, path).count() == 20
    tables.write_layer(first.limit(0), path)
    assert tables.read_layer(spark, path).columns == ["id", "v"] and tables.read_layer(spark, path).count() == 0


def test_compaction_reads_one_folder(spark, tmp_path):
    store = TrackStore(spark, f"{tmp_path}/store")
    assert store.compact() is None and store.vacuum() == []
    shifted = [(x + 1, y) for x, y in RING]
    for name, ring in (("AAA-1-1-1", RING), ("AAA-1-1-2", RING), ("AAA-1-1-1", shifted), ("AAA-1-1-1-1", RING)):
        import_batch(store, vertices(spark, [(name, [ring])]), label=f"{name} {ring[0]}")
    rows = lambda: [sorted(map(tuple, t.collect())) for f in map(store.features, ("area", "plot")) for t in (f.table, f.vertices)]
    # the first batch's line was replaced: its folder is not read any more
    scanned = lambda: re.search(r"PartitionFilters: \[.*?version#\d+ (IN \([\d,]+\)|= \d+)", store.features("area").vertices._jdf.queryExecution().toString())[1]
    assert scanned() == "IN (1,2)"
    before = rows()
    version = store.compact()
    assert rows() == before and version == 4
    assert scanned() == "= 4"
    gone = store.vacuum()
    assert "vertices/version=0" in gone and rows() == before
    import_batch(store, vertices(spark, [("AAA-2-2-2", [RING])]), label="later")
    assert store.features("area").table.count() == 3 and store.refresh("all")


def test_report_parts_are_one_document(spark, tmp_path):
    """The parts, in the order of their names, are the document, whatever their number."""
    import xml.etree.ElementTree as ET

    layer = spark.range(12_000).select("id", F.concat(F.lit("<&>'\n> <b\r"), "id").alias("label"), geo.make_point(F.col("id") * 1.0, F.lit(2.0)).alias("geometry"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kml.write_kml(placemarks(layer, ["id"]), f"{tmp_path}/report")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    parts = sorted(p for p in (tmp_path / "report").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 2
    root = ET.fromstring("".join(p.read_text() for p in parts))
    space = "{http://earth.google.com/kml/2.0}"
    (folder,) = root.findall(f"{space}Folder")
    names = [m.find(f"{space}name").text for m in folder.findall(f"{space}Placemark")]
    assert names == [f"Feature_{i}" for i in range(1, 12_001)]
    assert kml.read_kml(spark, f"{tmp_path}/report").exceptAll(
        placemarks(layer, ["id"]).select("name", "styleUrl", "description", "coordinates")
    ).count() == 0
    kml.write_kml(placemarks(layer.limit(0), ["id"]), f"{tmp_path}/none.kml", join=True)
    assert len(ET.fromstring((tmp_path / "none.kml").read_text()).find(f"{space}Folder").findall(f"{space}Placemark")) == 0


@pytest.mark.parametrize(
    "cuts",
    [
        [[0, 1], [2, 3, 4]],  # whole parts in each batch, and in both together
        [[0], [1], [2, 3], [4]],
        [[4, 3], [2], [], [1, 0], [0, 1]],  # out of order, an empty batch, and rows that come twice
    ],
)
def test_tracks_are_held_until_they_are_whole(spark, tmp_path, cuts):
    line = [(0, 1, 2.0, 9.0), (0, 2, 2.1, 9.0), (1, 1, 2.1, 9.0), (1, 2, 2.1, 9.1), (1, 3, 2.0, 9.0)]
    rows = [("s", 1, "AAA-1-1-1", *p) for p in line]
    other = [("s", 2, "AAA-1-1-2", *p) for p in line]
    spark.createDataFrame([("s", 1, 2, 5), ("t", 1, 9, 9)], "src string, ogc_fid long, parts int, points long").write.parquet(f"{tmp_path}/totals")
    landing, offsets, store = f"{tmp_path}/landing", f"{tmp_path}/offsets", TrackStore(spark, f"{tmp_path}/store")
    held = []
    for cut in cuts:
        # nothing is stated for the other track, so it is never whole
        part = [rows[i] for i in cut] + other[:1]
        spark.createDataFrame(part, TRACK_VERTICES).write.mode("append").parquet(landing)
        stream_vertices(spark, landing, store, offsets, totals=f"{tmp_path}/totals").awaitTermination()
        held.append({r.ogc_fid for r in held_tracks(spark, store, offsets).collect()})
        areas = store.features("area")
        names = [] if areas is None else [r.area_id for r in areas.table.collect()]
        seen = {i for earlier in cuts[: len(held)] for i in earlier}
        assert names == (["AAA-1-1-1"] if seen == set(range(5)) else [])
    assert 2 in held[-1] and all(1 in h for h in held[: 1])
    points = store.features("area").vertices.orderBy("pt_no").collect()
    assert [(p.x, p.y) for p in points] == RING


def test_geojson_to_table(spark, tmp_path):
    point = {"type": "Point", "coordinates": [1.0, 2.0]}
    text = collection([feature(point, name="a", n=1), feature(point, n=2, other=True), feature(None, name="c")])
    (tmp_path / "c.json").write_text(text)
    (tmp_path / "empty.json").write_text(collection([]))
    name = f"t{uuid.uuid4().hex}"
    geojson.geojson_to_table(spark, f"{tmp_path}/c.json", name, path=f"{tmp_path}/t")
    got = spark.table(name)
    # the fields of the first feature, and no others
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["n bigint", "name string", "geom_type string", "coordinates string"]
    assert sorted(map(str, ((r.n, r.name, r.geom_type) for r in got.collect()))) == sorted(map(str, [(1, "a", "Point"), (2, None, "Point"), (None, "c", None)]))
    for schema in (None, T.StructType([T.StructField("n", T.LongType())])):
        with pytest.raises(ValueError, match="no features"):
            geojson.geojson_to_table(spark, f"{tmp_path}/empty.json", f"{name}_e", schema)
    with pytest.raises(Exception, match="already exists"):
        geojson.geojson_to_table(spark, f"{tmp_path}/c.json", name)
    spark.sql(f"DROP TABLE {name}")


def test_boundaries_are_appended(spark, tmp_path):
    raw = fx.boundaries(spark, SMALL).withColumn("more", F.lit("x"))
    for level in (0, 1, 2):
        first = append_boundaries(raw, level, str(tmp_path))
        table = read_boundaries(spark, level, str(tmp_path))
        assert table.columns == boundaries.COLUMNS and len(boundaries.COLUMNS) == 10
        assert first.where("reason = 'reference system'").count() > 0
        again = append_boundaries(raw.withColumn("ogc_fid", F.col("ogc_fid") + 1000 * (F.col("ogc_fid") % 2)), level, str(tmp_path))
        stored = read_boundaries(spark, level, str(tmp_path))
        ids = [r.ogc_fid for r in stored.collect()]
        assert len(ids) == len(set(ids)) > table.count()
        assert again.where("reason = 'repeated ogc_fid'").count() == table.where("ogc_fid % 2 = 0").count()


def test_bounds_carry_the_reference_system(spark):
    points = spark.createDataFrame([(1.0, 2.0, 4326), (3.0, 5.0, 4326)], "x double, y double, srid int")
    assert tuple(layers.bounds(points).first()) == (1.0, 2.0, 3.0, 5.0, 4326)
    assert {r.srid for r in layers.square_grid(layers.bounds(points), 1.0).collect()} == {4326}
    assert layers.square_grid(layers.bounds(points.limit(0)), 1.0).columns[-1] == "srid"
    with pytest.raises(Exception, match="several reference systems"):
        layers.bounds(points.unionByName(points.withColumn("srid", F.lit(3857)))).collect()


def test_report_lines_are_made_behind_the_exchange_and_as_xml(spark):
    texts = [
        "a b", "", " a ", "<b>&amp;</b>", "a\"b'c", "]]>", ">", "a]>b", "\n", "a\nb", "a\rb", "\t", "\x7f", "\u00e9\U0001f600", None, "x" * 5000 + "<>&", "y" + "<>&> " * 170, "y" + "<b>& " * 170,
    ]
    rows = [(i + 1, t, "#s", u, "1.0,2.0" if t else None) for i, (t, u) in enumerate((t, u) for t in texts for u in texts)]
    marks = spark.createDataFrame(rows, "idx long, name string, styleUrl string, description string, coordinates string")
    placemark = F.struct("name", "styleUrl", "description", F.struct("coordinates").alias("Point"))
    xml = F.regexp_replace(F.to_xml(placemark, {"rowTag": "Placemark"}), r">\s*\n\s*<", "><")
    want = marks.select("idx", F.regexp_replace(F.regexp_replace(xml, "\r", "&#13;"), "\n", "&#10;").alias("line"))
    got = kml.report_lines(marks).where("place > 0")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    plan = kml._in_order(marks)._jdf.queryExecution().analyzed().toString()
    assert plan.index("to_xml") < plan.index("RepartitionByExpression")
    assert plan.count("to_xml") == 1
