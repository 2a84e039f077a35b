"""Inputs in the shape of the jobs' tables, derived from the given tables.

The blocks that are plain SQL are written once and run on Spark and, as the check's
starting rows, on any other SQL engine. Tracks are built with the skew-safe operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from geotracks.functions import geometry as geo
from geotracks.operators.ordering import number_rows

# Column expressions shared by both engines.
_TRACK_EVENT_COLUMNS = [
    "user_id AS u",
    "CAST(floor(user_id / 5) AS INT) AS g",
    "user_id % 5 AS r",
    "event_id",
    "2 + CAST((user_id * 131) % 97 AS DOUBLE) / 50"
    " + CAST((event_id * 7919) % 1009 AS DOUBLE) / 100000 AS lon",
    "9 + CAST((user_id * 37) % 89 AS DOUBLE) / 50"
    " + CAST((event_id * 104729) % 997 AS DOUBLE) / 100000 AS lat",
]
#: Event points of a small region, whatever the user.
EVENT_POINT_COLUMNS = [
    "event_id",
    "2 + CAST((event_id * 7919) % 1009 AS DOUBLE) / 100000 AS lon",
    "9 + CAST((event_id * 104729) % 997 AS DOUBLE) / 100000 AS lat",
]
#: Edges of a part of the chained tracks.
CHAIN_PART = 4
_AREA_NAME = (
    "concat(CASE g % 4 WHEN 0 THEN 'AAA' WHEN 1 THEN 'BBB' WHEN 2 THEN 'CCC' ELSE 'DDD' END,"
    " '-', CAST(1 + g % 4 AS STRING), '-', CAST(1 + g % 9 AS STRING), '-', CAST(g AS STRING))"
)
_TRACK_NAME = (
    "CASE WHEN r = 0 THEN area_name"
    " WHEN r < 4 THEN concat(area_name, '-', CAST(r AS STRING))"
    " WHEN g % 3 = 0 THEN concat(area_name, '-x')"
    " WHEN g % 3 = 1 THEN concat('Q', area_name)"
    " ELSE concat(area_name, chr(10)) END"
)

# Some tracks are in the second batch only, some in the first only; no event is left out.
_BATCH = (
    "CASE WHEN user_id % 4 = 0 THEN 2 WHEN user_id % 11 = 0 THEN 1"
    " WHEN ts < {midnight} THEN 1 ELSE 2 END AS batch_no"
)

TRACK_POINTS_SQL = f"""
WITH e AS (
  SELECT {", ".join(_TRACK_EVENT_COLUMNS)},
         {_BATCH.format(midnight="TIMESTAMP '2024-01-16 00:00:00'")}
  FROM events),
a AS (
  SELECT *, {_AREA_NAME} AS area_name,
         row_number() OVER (PARTITION BY u, batch_no ORDER BY event_id) AS k,
         count(*) OVER (PARTITION BY u, batch_no) AS n
  FROM e),
p AS (
  SELECT u, batch_no, k * 10 AS ord, CASE WHEN k <= n / 2 THEN 0 ELSE 1 END AS seg_no,
         lon, lat, area_name, g, r FROM a
  UNION ALL
  SELECT u, batch_no, k * 10 + 5, 1, lon, lat, area_name, g, r FROM a
   WHERE u % 7 <> 0 AND k = CAST(floor(n / 2) AS INT)
  UNION ALL
  SELECT u, batch_no, (n + 1) * 10, 1, lon, lat, area_name, g, r FROM a
   WHERE u % 3 = 0 AND k = 1)
SELECT batch_no, u + 1 AS ogc_fid, {_TRACK_NAME} AS name, seg_no,
       CAST(row_number() OVER (PARTITION BY batch_no, u, seg_no ORDER BY ord) AS INT) AS pt_no,
       lon, lat
FROM p
"""

SITES_SQL = """
SELECT CASE WHEN c_custkey % 50 = 0 THEN 'store_name' WHEN c_custkey % 41 = 1 THEN NULL
            ELSE c_name END AS store_name,
       concat('site ', CAST(c_custkey AS STRING)) AS site_name,
       CAST(c_custkey AS STRING) AS site_number,
       CASE WHEN c_custkey % 50 = 0 THEN 'latitude' WHEN c_custkey % 9 = 1 THEN ''
            WHEN c_custkey % 13 = 2 THEN NULL
            ELSE concat(CAST(9 + c_custkey % 5 AS STRING), '.',
                        CAST(100 + c_custkey % 900 AS STRING)) END AS latitude,
       CASE WHEN c_custkey % 50 = 0 THEN 'longitude' WHEN c_custkey % 8 = 3 THEN ''
            ELSE concat('-', CAST(c_custkey % 7 AS STRING), '.',
                        CAST(100 + (c_custkey * 7) % 900 AS STRING)) END AS longitude,
       CAST(c_custkey % 400 AS STRING) AS altitude, CAST(c_custkey % 12 AS STRING) AS gatewidth,
       c_mktsegment AS ownername, '' AS comments,
       CAST(c_nationkey AS STRING) AS countrygeofeature_id,
       CAST(c_nationkey * 10 + c_custkey % 10 AS STRING) AS adm1geofeature_id,
       CAST(c_nationkey * 100 + c_custkey % 100 AS STRING) AS adm2geofeature_id
FROM {customer}
"""

BOUNDARIES_SQL = """
SELECT n_nationkey + 1 AS ogc_fid,
       CASE WHEN n_nationkey % 6 = 5 THEN 'Polygon' ELSE 'MultiPolygon' END AS geom_type,
       CASE WHEN n_nationkey % 11 = 7 THEN 3857 ELSE 4326 END AS srid,
       CAST(n_nationkey % 5 AS DOUBLE) AS minx, CAST(floor(n_nationkey / 5) AS DOUBLE) AS miny,
       CAST(n_nationkey % 5 + 1 AS DOUBLE) AS maxx,
       CAST(floor(n_nationkey / 5) + 1 AS DOUBLE) AS maxy,
       'Member State' AS status, '1000' AS str_year, '3000' AS exp_year, 'NO' AS disp_area,
       CASE WHEN n_nationkey % 9 = 4 THEN 'n/a' ELSE CAST(n_nationkey AS STRING) END AS adm0_code,
       n_name AS adm0_name, '4.00000000000' AS shape_leng, '1.00000000000' AS shape_area
FROM {nation}
"""

TARGET_SQL = """
SELECT s_suppkey AS fid, concat('K', CAST(s_suppkey AS STRING)) AS code, s_name AS label,
       s_acctbal AS val, s_nationkey AS cat, CAST(s_suppkey % 10 AS DOUBLE) AS x,
       CAST(s_suppkey % 7 AS DOUBLE) AS y
FROM {supplier}
"""

# {twice} is the supplier table with each row once per i in (0, 1): every supplier, and some twice.
# A third has keys that the target lacks.
SOURCE_SQL = """
SELECT CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 2000000 + i * 1000000
            ELSE s_suppkey + i * 1000000 END AS fid,
       s_suppkey * 2 + i AS seq,
       CASE WHEN s_suppkey % 25 = 6 THEN NULL
            WHEN s_suppkey % 3 = 0 THEN concat('N', CAST(s_suppkey AS STRING))
            ELSE concat('K', CAST(s_suppkey AS STRING)) END AS code,
       s_name AS label,
       CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal + 1 + i ELSE s_acctbal END AS val,
       s_nationkey AS cat, CAST(s_suppkey % 10 AS DOUBLE) AS x,
       CAST(s_suppkey % 7 AS DOUBLE) AS y
FROM {twice}
WHERE i = 0 OR s_suppkey % 12 = 0 OR s_suppkey % 20 = 4
"""
_TWICE = "(SELECT *, unnest([0, 1]) AS i FROM supplier)"

#: Check-side text of each fixture, by name.
CHECK_SQL = {
    "fx_event_points": f"SELECT {', '.join(EVENT_POINT_COLUMNS)} FROM events",
    "fx_track_points": TRACK_POINTS_SQL,
    "fx_sites": SITES_SQL.format(customer="customer"),
    "fx_boundaries": BOUNDARIES_SQL.format(nation="nation"),
    "fx_target": TARGET_SQL.format(supplier="supplier"),
    "fx_source": SOURCE_SQL.format(twice=_TWICE),
    "fx_exclude_plots": """
        SELECT name AS id FROM fx_track_points WHERE ogc_fid % 10 = 3
        UNION SELECT 'ZZZ-0-0-0-0'""",
    "fx_exclude_areas": """
        SELECT name AS id FROM fx_track_points WHERE ogc_fid % 10 = 6
        UNION ALL SELECT 'ZZZ-0-0-0'""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def track_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``TRACK_VERTICES`` rows: one track per (batch, user), src is the batch number."""
    events = (
        table(spark, sf_dir, "events")
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        .selectExpr(*_TRACK_EVENT_COLUMNS, _BATCH.format(midnight="TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    )
    walked = number_rows(events, ["event_id"], by=["u", "batch_no"], name="k", total="n")
    half = F.expr("CAST(floor(n / 2) AS BIGINT)")
    bridged = (F.col("u") % 7 != 0) & (half >= 1)
    # Points of the second part start after the repeated joint, when there is one.
    second = F.col("k") - half + bridged.cast("int")
    second_size = F.col("n") - half + bridged.cast("int")
    place = lambda seg, pt: F.struct(
        seg.cast("int").alias("seg_no"), pt.cast("long").alias("pt_no")
    )
    places = F.array(
        F.when(F.col("k") <= half, place(F.lit(0), F.col("k"))).otherwise(
            place(F.lit(1), second)
        ),
        F.when(bridged & (F.col("k") == half), place(F.lit(1), F.lit(1))),
        F.when((F.col("u") % 3 == 0) & (F.col("k") == 1), place(F.lit(1), second_size + 1)),
    )
    return (
        walked.withColumn("area_name", F.expr(_AREA_NAME))
        .select("*", F.explode(places).alias("place"))
        .where("place IS NOT NULL")
        .selectExpr(
            "CAST(batch_no AS STRING) AS src",
            "u + 1 AS ogc_fid",
            f"{_TRACK_NAME.replace('chr(10)', 'char(10)')} AS name",
            "place.seg_no",
            "place.pt_no",
            "lon AS x",
            "lat AS y",
        )
    )


def chained_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of tracks whose parts of ``CHAIN_PART`` edges touch; one track has a third of all events."""
    track = F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id"))
    events = table(spark, sf_dir, "events").select(
        track.alias("track"), *[F.expr(c) for c in EVENT_POINT_COLUMNS]
    )
    walked = number_rows(events, ["event_id"], by=["track"], name="k")
    # The last point of a part is the first of the next one too.
    part = F.floor((F.col("k") - 1) / CHAIN_PART)
    ends = (F.col("k") > 1) & ((F.col("k") - 1) % CHAIN_PART == 0)
    place = lambda seg: F.struct(
        seg.cast("int").alias("seg_no"), (F.col("k") - seg * CHAIN_PART).cast("long").alias("pt_no")
    )
    places = F.array_compact(F.array(place(part), F.when(ends, place(part - 1))))
    return walked.select("track", F.explode(places).alias("at"), F.col("lon").alias("x"), F.col("lat").alias("y")).select(
        "track", "at.*", "x", "y"
    )


def exclude_plots(vertices: DataFrame) -> DataFrame:
    """Ids to flag among plots; one exists nowhere."""
    return _ids(vertices, 3, "ZZZ-0-0-0-0")


def exclude_areas(vertices: DataFrame) -> DataFrame:
    """Ids to flag among areas, with repeats (once per batch)."""
    return _ids(vertices, 6, "ZZZ-0-0-0")


def _ids(vertices: DataFrame, remainder: int, unknown: str) -> DataFrame:
    spark = vertices.sparkSession
    hits = (
        vertices.where(F.col("ogc_fid") % 10 == remainder)
        .select("src", F.col("name").alias("id"))
        .distinct()
        .select("id")
    )
    return hits.unionByName(spark.range(1).select(F.lit(unknown).alias("id")))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SITES_SQL, customer=table(spark, sf_dir, "customer"))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(BOUNDARIES_SQL, nation=table(spark, sf_dir, "nation"))
    ring = geo.square(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")])
    return raw.withColumn("wkb_geometry", F.array(F.array(ring)))


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TARGET_SQL, supplier=table(spark, sf_dir, "supplier"))


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    twice = suppliers.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    return spark.sql(SOURCE_SQL, twice=twice)
