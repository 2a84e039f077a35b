"""Independent SQL for the registered queries, for a single-node engine on the same tables.

Written from the meaning of each job, not from its Spark plan: hulls by testing every pair
of points, merges by windows over the source rows. Meant for small scale factors.
"""

from __future__ import annotations

from geotracks.fixtures import CHECK_SQL
from geotracks.operators.flags import EXCLUDED_AREAS, EXCLUDED_PLOTS

_RING_METRES = "6378137.0"
_MX = f"{_RING_METRES} * radians({{0}})"
_MY = f"{_RING_METRES} * ln(tan(pi() / 4 + radians({{0}}) / 2))"

# Patterns of the names of areas and plots.
_AREA = "regexp_matches(name, '^.{3}-[0-9]+-[0-9]+-[0-9]+$', 's')"
_PLOT = "regexp_matches(name, '^.{3}-[0-9]+-[0-9]+-[0-9]+-[0-9]+$', 's')"
_AREA_KEY = "nullif(regexp_extract(name, '^.{3}-[0-9]+-[0-9]+-[0-9]+', 0, 's'), '')"



def _hull_edges(points: str, keys: str) -> str:
    """Hull edges of each group: a-b is an edge if no c lies right of it or beyond it."""
    return f"""SELECT {keys}, ax, ay, qx, qy, strip FROM (
        SELECT {keys}, a.lon AS ax, a.lat AS ay, b.lon AS qx, b.lat AS qy,
          (b.mx - a.mx) * (b.my + a.my) / 2 AS strip,
          (b.lon - a.lon) * (c.lat - a.lat) - (b.lat - a.lat) * (c.lon - a.lon) AS turn,
          (c.lon - a.lon) * (b.lon - a.lon) + (c.lat - a.lat) * (b.lat - a.lat) AS along,
          (b.lon - a.lon) ** 2 + (b.lat - a.lat) ** 2 AS length
        FROM {points} a JOIN {points} b USING ({keys}) JOIN {points} c USING ({keys})
        WHERE a.lon <> b.lon OR a.lat <> b.lat)
      GROUP BY {keys}, ax, ay, qx, qy, strip
      HAVING bool_and(turn > 1e-14 OR (turn >= -1e-14 AND along BETWEEN -1e-14 AND length + 1e-14))"""


def _hulls(edges: str, keys: str) -> str:
    """Hull hectares of each group."""
    return f"SELECT {keys}, abs(coalesce(sum(strip), 0)) / 10000 AS hectares FROM {edges} GROUP BY {keys}"


# Common table expressions by name, each with those it needs.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    **{name: ((), sql) for name, sql in CHECK_SQL.items()},
    "fx_exclude_plots": (("fx_track_points",), CHECK_SQL["fx_exclude_plots"]),
    "fx_exclude_areas": (("fx_track_points",), CHECK_SQL["fx_exclude_areas"]),
    "pts": (
        ("fx_track_points",),
        f"""SELECT *, {_MX.format("lon")} AS mx, {_MY.format("lat")} AS my FROM fx_track_points""",
    ),
    "heads": (
        ("fx_track_points",),
        f"""SELECT DISTINCT batch_no, ogc_fid, name,
              CASE WHEN {_AREA} THEN 'area' WHEN {_PLOT} THEN 'plot' END AS kind,
              {_AREA_KEY} AS area_key
            FROM fx_track_points""",
    ),
    "edges": (
        ("pts",),
        """SELECT *, (lead(mx) OVER w - mx) * (lead(my) OVER w + my) / 2 AS strip
           FROM pts WINDOW w AS (PARTITION BY batch_no, ogc_fid, seg_no ORDER BY pt_no)""",
    ),
    "segs": (
        ("edges",),
        """SELECT batch_no, ogc_fid, seg_no, count(*) AS n, sum(strip) AS strip,
             arg_min(lon, pt_no) AS sx, arg_min(lat, pt_no) AS sy,
             arg_max(lon, pt_no) AS ex, arg_max(lat, pt_no) AS ey,
             arg_min(mx, pt_no) AS smx, arg_min(my, pt_no) AS smy,
             arg_max(mx, pt_no) AS emx, arg_max(my, pt_no) AS emy
           FROM edges GROUP BY ALL HAVING count(*) > 1""",
    ),
    # Two parts at most: they link at the middle, around the start, or both.
    "links": (
        ("segs",),
        """SELECT batch_no, ogc_fid,
             CASE WHEN a.n IS NULL OR b.n IS NULL THEN 1 ELSE 2 END AS parts,
             coalesce(a.n, 0) + coalesce(b.n, 0) AS n,
             coalesce(a.strip, 0) + coalesce(b.strip, 0) AS strip,
             coalesce(a.sx = a.ex AND a.sy = a.ey, true) AS a_closed,
             coalesce(b.sx = b.ex AND b.sy = b.ey, true) AS b_closed,
             coalesce(a.ex = b.sx AND a.ey = b.sy, false) AS middle,
             coalesce(b.ex = a.sx AND b.ey = a.sy, false) AS around,
             CASE WHEN a.n IS NULL THEN (b.smx - b.emx) * (b.smy + b.emy) / 2
                  WHEN b.n IS NULL THEN (a.smx - a.emx) * (a.smy + a.emy) / 2 END AS close_one,
             (a.smx - b.emx) * (a.smy + b.emy) / 2 AS close_ab,
             (b.smx - a.emx) * (b.smy + a.emy) / 2 AS close_ba
           FROM (SELECT * FROM segs WHERE seg_no = 0) a
           FULL JOIN (SELECT * FROM segs WHERE seg_no = 1) b USING (batch_no, ogc_fid)""",
    ),
    "shapes": (
        ("links",),
        """SELECT batch_no, ogc_fid, lines, closed, points,
             CASE WHEN lines = 1 OR closed THEN points + CASE WHEN closed THEN 0 ELSE 1 END
               END AS ring_points,
             CASE WHEN lines = 1 THEN abs(strip + CASE WHEN parts = 1 THEN close_one
                 WHEN middle THEN close_ab ELSE close_ba END) / 10000 END AS hectares
           FROM (SELECT *,
                   CASE WHEN parts = 2 AND (a_closed OR b_closed OR NOT (middle OR around))
                     THEN 2 ELSE 1 END AS lines,
                   CASE WHEN parts = 1 OR a_closed OR b_closed THEN a_closed AND b_closed
                     ELSE middle AND around END AS closed,
                   n - CASE WHEN parts = 2 AND NOT a_closed AND NOT b_closed
                     AND (middle OR around) THEN 1 ELSE 0 END AS points
                 FROM links)""",
    ),
    # State after both batches: fid by first batch and name, geometry of the last batch.
    "state": (
        ("heads",),
        """SELECT kind, name, area_key AS area_id, min(batch_no) AS first_batch,
             max(batch_no) AS batch_no, arg_max(ogc_fid, batch_no) AS ogc_fid,
             row_number() OVER (PARTITION BY kind ORDER BY min(batch_no), name) AS fid
           FROM heads WHERE kind IS NOT NULL GROUP BY kind, name, area_key""",
    ),
    "hull_edges": (("points",), _hull_edges("points", "batch_no, ogc_fid")),
    "hulls": (("hull_edges",), _hulls("hull_edges", "batch_no, ogc_fid")),
    # The points of the lines that are one: the part that comes second begins behind the joint.
    "rings": (
        ("pts", "links", "shapes", "segs"),
        """SELECT batch_no, ogc_fid, lon, lat, closed,
             row_number() OVER (PARTITION BY batch_no, ogc_fid ORDER BY later, pt_no) AS pt_no,
             count(*) OVER (PARTITION BY batch_no, ogc_fid) AS n
           FROM (SELECT p.batch_no, p.ogc_fid, p.pt_no, lon, lat, sh.closed, parts,
                   (seg_no = 1) = middle AS later
                 FROM pts p JOIN shapes sh USING (batch_no, ogc_fid) JOIN links USING (batch_no, ogc_fid)
                 SEMI JOIN segs USING (batch_no, ogc_fid, seg_no) WHERE lines = 1)
           WHERE parts = 1 OR NOT later OR pt_no > 1""",
    ),
    # Short lines of two parts; the second starts at the end of the first in even blocks.
    "blocks": (
        ("fx_event_points",),
        f"""SELECT event_id // 20 AS block, lon, lat, {_MX.format("lon")} AS mx,
              {_MY.format("lat")} AS my,
              row_number() OVER (PARTITION BY event_id // 20 ORDER BY event_id) AS k,
              count(*) OVER (PARTITION BY event_id // 20) AS n
            FROM fx_event_points""",
    ),
    "block_edges": (
        ("blocks",),
        """SELECT *, (lead(mx) OVER w - mx) * (lead(my) OVER w + my) / 2 AS strip,
             (first(mx) OVER w - last(mx) OVER whole) * (first(my) OVER w + last(my) OVER whole) / 2
               AS closing
           FROM blocks
           WINDOW w AS (PARTITION BY block ORDER BY k), whole AS (PARTITION BY block)""",
    ),
    "block_points": (
        ("blocks",),
        "SELECT DISTINCT block, lon, lat, mx, my FROM blocks",
    ),
    "block_hull_edges": (("block_points",), _hull_edges("block_points", "block")),
    "block_hulls": (("block_hull_edges",), _hulls("block_hull_edges", "block")),
    "points": (("pts",), "SELECT DISTINCT batch_no, ogc_fid, lon, lat, mx, my FROM pts"),
    "convex": (
        ("state", "shapes", "hulls"),
        """SELECT s.kind, s.fid, s.name, s.area_id,
             CASE WHEN sh.ring_points IS NOT NULL THEN h.hectares END AS hectares
           FROM state s LEFT JOIN shapes sh USING (batch_no, ogc_fid)
           LEFT JOIN hulls h USING (batch_no, ogc_fid)""",
    ),
    "box": (
        ("fx_track_points",),
        """SELECT min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy
           FROM fx_track_points""",
    ),
    "frame": (
        ("box",),
        """SELECT nx, ny, minx + (maxx - minx) / 2 - nx * 0.05 / 2 AS minx,
             miny + (maxy - miny) / 2 - ny * 0.05 / 2 AS miny
           FROM (SELECT *, CAST(trunc((maxx - minx) / CAST(0.05 AS DOUBLE)) AS BIGINT) + 1 AS nx,
                   CAST(trunc((maxy - miny) / CAST(0.05 AS DOUBLE)) AS BIGINT) + 1 AS ny FROM box)""",
    ),
    # Merge on code: one row per source row, with the target row its key finds.
    "walk": (
        ("fx_source", "fx_target"),
        """SELECT s.*, t.fid AS t_fid,
             row_number() OVER first_up AS rn,
             row_number() OVER (PARTITION BY coalesce(s.code, 'null ' || s.seq)
                                ORDER BY s.seq DESC) AS rd,
             (s.label, s.val, s.cat, s.x, s.y) AS now,
             lag((s.label, s.val, s.cat, s.x, s.y)) OVER first_up AS before,
             CASE WHEN t.fid IS NOT NULL THEN (t.label, t.val, t.cat, t.x, t.y) END AS old
           FROM fx_source s LEFT JOIN fx_target t ON s.code = t.code
           WINDOW first_up AS (PARTITION BY coalesce(s.code, 'null ' || s.seq) ORDER BY s.seq)""",
    ),
    # The same on the number that many target rows share; the first of them is found.
    "walk_cat": (
        ("fx_source", "fx_target"),
        """SELECT s.*, t.fid AS t_fid,
             row_number() OVER first_up AS rn,
             row_number() OVER (PARTITION BY s.cat ORDER BY s.seq DESC) AS rd,
             (s.code, s.label, s.val, s.x, s.y) AS now,
             lag((s.code, s.label, s.val, s.x, s.y)) OVER first_up AS before,
             (t.code, t.label, t.val, t.x, t.y) AS old
           FROM fx_source s JOIN fx_target t ON s.cat = t.cat
             AND t.fid = (SELECT min(fid) FROM fx_target u WHERE u.cat = s.cat)
           WINDOW first_up AS (PARTITION BY s.cat ORDER BY s.seq)""",
    ),
    "last_fid": (("fx_target",), "SELECT max(fid) AS m FROM fx_target"),
}


def _with(*needed: str) -> str:
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for other in _CTES[name][0]:
                add(other)
            done.append(name)

    for name in needed:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n][1]})" for n in done) + "\n"


def _convex(kind: str, columns: str) -> str:
    return (
        _with("convex")
        + f"SELECT {columns}, 0 AS clazz, round(hectares, 4) AS hectares FROM convex WHERE kind = '{kind}'"
    )


def _concave(kind: str, columns: str) -> str:
    """No point is outside, and a hull of a smaller share is no larger: the same for every feature."""
    return (
        _with("convex")
        + f"""SELECT {columns}, 0 AS clazz, round(hectares, 4) AS hectares,
             CASE WHEN hectares IS NOT NULL THEN CAST(0 AS BIGINT) END AS outside,
             CASE WHEN hectares IS NOT NULL THEN true END AS ordered
           FROM convex WHERE kind = '{kind}'"""
    )


def _convex_edges(kind: str) -> str:
    return (
        _with("state", "shapes", "hull_edges")
        + f"""SELECT fid, round(ax, 9) AS x, round(ay, 9) AS y, round(qx, 9) AS next_x, round(qy, 9) AS next_y
           FROM state JOIN shapes USING (batch_no, ogc_fid) JOIN hull_edges USING (batch_no, ogc_fid)
           WHERE kind = '{kind}' AND ring_points IS NOT NULL"""
    )


def _polygon_vertices(kind: str) -> str:
    return (
        _with("state", "shapes", "rings")
        + f"""SELECT fid, r.pt_no, lon AS x, lat AS y FROM state JOIN shapes sh USING (batch_no, ogc_fid)
             JOIN (SELECT batch_no, ogc_fid, pt_no, lon, lat FROM rings
                   UNION ALL SELECT batch_no, ogc_fid, n + 1, lon, lat FROM rings WHERE pt_no = 1 AND NOT closed) r
               USING (batch_no, ogc_fid)
           WHERE kind = '{kind}' AND lines = 1 AND ring_points >= 4"""
    )


def _polygon(kind: str, columns: str) -> str:
    return (
        _with("state", "shapes")
        + f"""SELECT {columns}, 0 AS clazz,
             round(CASE WHEN ring_points >= 4 AND lines = 1 THEN hectares END, 4) AS hectares,
             ring_points AS points
           FROM state LEFT JOIN shapes USING (batch_no, ogc_fid) WHERE kind = '{kind}'"""
    )


def _upsert(kind: str, columns: str, listed: str) -> str:
    # Flags set after batch 1 last only where batch 2 brings nothing.
    return (
        _with("state", "shapes", listed)
        + f"""SELECT {columns}, CASE WHEN first_batch = 1 AND batch_no = 1
               AND name IN (SELECT id FROM {listed}) THEN 1 ELSE 0 END AS clazz,
             ring_points AS points
           FROM state LEFT JOIN shapes USING (batch_no, ogc_fid) WHERE kind = '{kind}'"""
    )


def _listed(ids: list[str]) -> str:
    return ", ".join(f"'{i}'" for i in dict.fromkeys(ids))


def _flag(kind: str, columns: str, listed: str) -> str:
    return (
        _with("state", listed)
        + f"""SELECT {columns}, CASE WHEN name IN (SELECT id FROM {listed}) THEN 1 ELSE 0 END AS clazz
           FROM state WHERE kind = '{kind}'"""
    )


_FIELDS = ("code", "label", "val", "cat", "x", "y")
_UPDATED = f"""
SELECT t.fid, t.code, {", ".join(f"CASE WHEN w.fid IS NULL THEN t.{c} ELSE w.{c} END AS {c}" for c in _FIELDS[1:])}
FROM fx_target t LEFT JOIN (SELECT * FROM walk WHERE rd = 1 AND t_fid IS NOT NULL) w
  ON w.t_fid = t.fid"""


def _appended(place: str) -> str:
    """Rows appended in the order their key first comes, with the values at ``place``."""
    return f"""
SELECT m + row_number() OVER (ORDER BY f.seq) AS fid, v.code, v.label, v.val, v.cat, v.x, v.y
FROM walk f JOIN walk v ON v.{place} = 1
  AND coalesce(v.code, 'null ' || v.seq) = coalesce(f.code, 'null ' || f.seq), last_fid
WHERE f.rn = 1 AND f.t_fid IS NULL"""


def _counts(updated: dict[str, str], appended: dict[str, str], compare: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, {compare} AS compare,
              count(*) FILTER (WHERE {updated[mode]}) AS updated,
              count(*) FILTER (WHERE {appended[mode]}) AS appended FROM walk"""
        for mode in updated
    )


_HIT = "t_fid IS NOT NULL"
_NEW = "t_fid IS NULL AND rn = 1"
_MOVED = "now IS DISTINCT FROM before AND rn > 1"
_PLAIN = (
    {"default": f"{_HIT} OR rn > 1", "update_only": _HIT, "append_only": "false"},
    {"default": _NEW, "update_only": "false", "append_only": _NEW},
)
_COMPARED = (
    {
        "default": f"({_MOVED}) OR ({_HIT} AND rn = 1 AND now IS DISTINCT FROM old)",
        "update_only": f"{_HIT} AND (({_MOVED}) OR (rn = 1 AND now IS DISTINCT FROM old))",
        "append_only": "false",
    },
    _PLAIN[1],
)
_DRY_APPENDS = {"default": "t_fid IS NULL", "update_only": "false", "append_only": "t_fid IS NULL"}
_DRY = ({"default": _HIT, "update_only": _HIT, "append_only": "false"}, _DRY_APPENDS)
_DRY_COMPARED = (
    {
        "default": f"{_HIT} AND now IS DISTINCT FROM old",
        "update_only": f"{_HIT} AND now IS DISTINCT FROM old",
        "append_only": "false",
    },
    _DRY_APPENDS,
)

_SITE_REST = "store_name, site_name, site_number, altitude, gatewidth, ownername, comments, countrygeofeature_id, adm1geofeature_id, adm2geofeature_id"
_BOUNDARY_OK = "geom_type = 'MultiPolygon' AND srid = 4326 AND try_cast(adm0_code AS DECIMAL(9, 0)) IS NOT NULL"
_BOUNDARY = f"""SELECT CAST(ogc_fid AS BIGINT) AS ogc_fid, status, CAST(str_year AS DOUBLE) AS str_year,
  CAST(exp_year AS DOUBLE) AS exp_year, disp_area, CAST(adm0_code AS DOUBLE) AS adm0_code, adm0_name,
  CAST(shape_leng AS DOUBLE) AS shape_leng, CAST(shape_area AS DOUBLE) AS shape_area,
  minx, miny, maxx, maxy
FROM fx_boundaries WHERE {_BOUNDARY_OK}"""
# Texts of the report.
_PROPERTY = (
    "'<ul><li><p><font color=\"green\">Property <b>{0}</b> has value <b>' || {1}"
    " || '</b></font></p></li></ul>'"
)
_DESCRIPTION = " || ".join(
    [
        "'<h1>Feature N. ' || idx || '</h1>'",
        *[
            _PROPERTY.format(n, f"CAST({n} AS VARCHAR)")
            for n in ("fid", "code", "label", "cat")
        ],
        _PROPERTY.format("geometry", "'POINT (' || x || ' ' || y || ')'"),
    ]
)

CHECKS: dict[str, str] = {
    "ben_hectares": _with("heads", "hulls")
    + """SELECT batch_no, ogc_fid, name, round(coalesce(hectares, 0), 4) AS hectares
         FROM heads LEFT JOIN hulls USING (batch_no, ogc_fid)""",
    "classify_tracks": _with("heads")
    + """SELECT batch_no, ogc_fid, name, kind,
           CASE WHEN kind IS NOT NULL THEN area_key END AS area_id FROM heads""",
    "area_tracks": _with("heads") + "SELECT batch_no, ogc_fid, name FROM heads WHERE kind = 'area'",
    "plot_tracks": _with("heads") + "SELECT batch_no, ogc_fid, name FROM heads WHERE kind = 'plot'",
    "plot_area_key": _with("heads") + "SELECT batch_no, ogc_fid, name, area_key FROM heads",
    "line_merge_ordered": _with("shapes")
    + "SELECT batch_no, ogc_fid, CAST(lines AS BIGINT) AS lines, points, closed FROM shapes",
    "line_merge_long": _with("fx_event_points")
    + """SELECT CAST(track AS BIGINT) AS track, CAST(0 AS INTEGER) AS line_no, count(*) AS points,
           round(arg_min(lon, event_id), 9) AS sx, round(arg_min(lat, event_id), 9) AS sy,
           round(arg_max(lon, event_id), 9) AS ex, round(arg_max(lat, event_id), 9) AS ey, false AS closed
         FROM (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS track, event_id
               FROM events) JOIN fx_event_points USING (event_id)
         GROUP BY track HAVING count(*) > 1""",
    "ring_close": _with("shapes")
    + """SELECT batch_no, ogc_fid, ring_points AS points, true AS closed,
           round(hectares, 4) AS hectares FROM shapes WHERE ring_points IS NOT NULL""",
    "area_upsert": _upsert("area", "fid, name AS area_id", "fx_exclude_areas"),
    "plot_upsert": _upsert("plot", "fid, area_id, name AS plot_id", "fx_exclude_plots"),
    "import_rejects": _with("heads", "shapes")
    + """SELECT batch_no, kind, name, 'parts do not join' AS reason, CAST(1 AS BIGINT) AS tracks
         FROM heads JOIN shapes USING (batch_no, ogc_fid)
         WHERE kind IS NOT NULL AND ring_points IS NULL""",
    "new_names_not_in": _with("heads")
    + """SELECT DISTINCT kind, name FROM heads WHERE batch_no = 2 AND kind IS NOT NULL
         AND name NOT IN (SELECT name FROM heads WHERE batch_no = 1 AND kind IS NOT NULL)""",
    "area_polygon": _polygon("area", "fid, name AS area_id"),
    "plot_polygon": _polygon("plot", "fid, name AS plot_id, area_id"),
    "area_convex": _convex("area", "fid, name AS area_id"),
    "plot_convex": _convex("plot", "fid, area_id, name AS plot_id"),
    "area_concave": _concave("area", "fid, name AS area_id"),
    "plot_concave": _concave("plot", "fid, area_id, name AS plot_id"),
    "area_convex_edges": _convex_edges("area"),
    "plot_convex_edges": _convex_edges("plot"),
    "area_polygon_vertices": _polygon_vertices("area"),
    "plot_polygon_vertices": _polygon_vertices("plot"),
    "flag_plots": _flag("plot", "fid, area_id, name AS plot_id", "fx_exclude_plots"),
    "flag_areas": _flag("area", "fid, name AS area_id", "fx_exclude_areas"),
    "flag_listed": f"""SELECT fid, area_id, plot_id, CAST(CASE WHEN area_id IN ({_listed(EXCLUDED_AREAS)}) THEN 2
             WHEN plot_id IN ({_listed(EXCLUDED_PLOTS)}) THEN 1 ELSE 0 END AS INTEGER) AS clazz
           FROM (SELECT c_custkey AS fid, 'GOR-4-2-' || c_custkey % 9 AS area_id, 'SAK-1-4-1-' || c_custkey % 15 AS plot_id FROM customer)""",
    "area_plot_reconcile": _with("convex")
    + """SELECT area_id, round(hectares, 3) AS hectares, round(plot_sum, 3) AS plot_sum,
           round(hectares - plot_sum, 3) AS difference
         FROM (SELECT a.area_id, a.hectares,
                 sum(p.hectares) OVER (PARTITION BY a.area_id) AS plot_sum
               FROM (SELECT * FROM convex WHERE kind = 'area') a
               JOIN (SELECT * FROM convex WHERE kind = 'plot') p ON a.area_id = p.area_id)""",
    "track_import_stream": _with("heads")
    + """SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY name) AS fid, name
         FROM (SELECT DISTINCT kind, name FROM heads WHERE kind IS NOT NULL)""",
    "store_compacted": _with("state", "shapes")
    + """SELECT fid, name AS area_id, 0 AS clazz, ring_points AS points
         FROM state LEFT JOIN shapes USING (batch_no, ogc_fid) WHERE kind = 'area'""",
    "stored_area_convex": _convex("area", "fid, name AS area_id"),
    "line_functions": _with("block_edges", "block_hulls")
    + """SELECT block, CAST(CASE WHEN n = 1 OR joined THEN 1 ELSE 2 END AS INTEGER) AS lines,
           n = 1 OR (n = 2 AND block % 2 = 1) AS closed,
           CASE WHEN n = 1 OR joined THEN round(start_x, 9) END AS start_x,
           CAST(CASE WHEN joined THEN n + 1 END AS INTEGER) AS ring_points,
           CASE WHEN joined THEN round(area, 2) END AS hectares,
           round(coalesce(hectares, 0), 2) AS hull_hectares
         FROM (SELECT block, any_value(n) AS n, block % 2 = 0 AND any_value(n) >= 4 AS joined,
                 arg_min(lon, k) AS start_x,
                 abs(sum(strip) + any_value(closing)) / 10000 AS area
               FROM block_edges GROUP BY block)
         LEFT JOIN block_hulls USING (block)""",
    "gpx_files": _with("blocks")
    + """SELECT 'BLK-0-0-' || block AS name, CAST(0 AS INTEGER) AS seg_no, k AS pt_no, lon AS x,
           lat AS y FROM blocks""",
    "sites_csv": _with("fx_sites")
    + f"""SELECT nullif(latitude, '') AS latitude, nullif(longitude, '') AS longitude,
            {", ".join(f"nullif({c}, '') AS {c}" for c in _SITE_REST.split(", "))}
          FROM fx_sites WHERE store_name IS NULL OR store_name <> 'store_name'""",
    "kml_report": f"""SELECT 'Feature_' || idx AS name, '#exampleStyleMap' AS "styleUrl", '<h1>Feature N. ' || idx || '</h1>' || {" || ".join(
        [*(_PROPERTY.format(n, f"CAST({n} AS VARCHAR)") for n in ("fid", "status", "customer")), _PROPERTY.format("geometry", "'POINT (' || x || ' ' || y || ')'")]
    )} AS description, y || ',' || x AS coordinates
    FROM (SELECT o_orderkey AS fid, o_orderstatus AS status, o_custkey AS customer, CAST(o_custkey % 360 - 180 AS DOUBLE) AS x,
            CAST(o_orderkey % 180 - 90 AS DOUBLE) AS y, row_number() OVER (ORDER BY o_orderkey) AS idx FROM orders)""",
    "kml_document": _with("fx_target")
    + """SELECT 'NAME' AS name, CAST(2 AS INTEGER) AS styles, 'exampleStyleMap' AS style_map, CAST(count(*) AS INTEGER) AS placemarks,
           'Feature_' || min(idx) AS first_name, arg_max(y || ',' || x, idx) AS last_coordinates
         FROM (SELECT *, row_number() OVER (ORDER BY fid) AS idx FROM fx_target)""",
    "surrogate_keys": """SELECT 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS fid,
           o_orderdate, o_orderkey FROM orders""",
    "feature_at": _with("fx_target") + "SELECT * FROM fx_target ORDER BY fid LIMIT 1 OFFSET 7",
    "first_features": _with("fx_target") + "SELECT * FROM fx_target ORDER BY fid LIMIT 5",
    "layer_count": _with("fx_track_points") + "SELECT count(*) AS features FROM fx_track_points",
    "layer_srid": _with("fx_boundaries") + "SELECT DISTINCT srid FROM fx_boundaries",
    "layer_bounds": _with("box") + "SELECT * FROM box",
    "grid_envelope": _with("frame")
    + """SELECT nx, ny, round(minx, 9) AS minx, round(miny, 9) AS miny,
           round(minx + nx * 0.05, 9) AS maxx, round(miny + ny * 0.05, 9) AS maxy FROM frame""",
    "grid_cells": _with("frame")
    + """SELECT r.range * nx + c.range + 1 AS cell_id, c.range AS col, r.range AS row,
           round(minx + c.range * 0.05, 9) AS minx, round(miny + r.range * 0.05, 9) AS miny,
           round(minx + (c.range + 1) * 0.05, 9) AS maxx,
           round(miny + (r.range + 1) * 0.05, 9) AS maxy, 5 AS points
         FROM frame, range(0, nx) c, range(0, ny) r""",
    "mercator_points": _with("pts")
    + """SELECT batch_no, ogc_fid, seg_no, CAST(pt_no AS BIGINT) AS pt_no, round(mx, 3) AS mx, round(my, 3) AS my FROM pts""",
    "merge_default": _with("fx_source", "fx_target", "last_fid")
    + """SELECT t.fid, CASE WHEN s.fid IS NULL THEN t.code ELSE s.code END AS code,
           coalesce(s.label, t.label) AS label, coalesce(s.val, t.val) AS val,
           coalesce(s.cat, t.cat) AS cat, coalesce(s.x, t.x) AS x, coalesce(s.y, t.y) AS y
         FROM fx_target t LEFT JOIN fx_source s ON s.fid = t.fid
         UNION ALL
         SELECT m + row_number() OVER (ORDER BY seq), code, label, val, cat, x, y
         FROM fx_source, last_fid WHERE fid NOT IN (SELECT fid FROM fx_target)""",
    "merge_by_field": _with("walk", "last_fid") + _UPDATED + " UNION ALL " + _appended("rd"),
    "merge_update_only": _with("walk") + _UPDATED,
    "merge_append_only": _with("walk", "last_fid")
    + "SELECT * FROM fx_target UNION ALL "
    + _appended("rn"),
    "merge_selected_fields": _with("walk")
    + """SELECT t.fid, t.code, t.label, CASE WHEN w.fid IS NULL THEN t.val ELSE w.val END AS val,
           t.cat, t.x, t.y
         FROM fx_target t LEFT JOIN (SELECT * FROM walk WHERE rd = 1) w ON w.t_fid = t.fid""",
    "merge_preserve_fid": _with("walk")
    + _UPDATED
    + """ UNION ALL
         SELECT f.fid, v.code, v.label, v.val, v.cat, v.x, v.y FROM walk f JOIN walk v ON v.rd = 1
           AND coalesce(v.code, 'null ' || v.seq) = coalesce(f.code, 'null ' || f.seq)
         WHERE f.rn = 1 AND f.t_fid IS NULL AND f.fid NOT IN (SELECT fid FROM fx_target)""",
    "merge_rejects": _with("walk")
    + """SELECT fid, 'append' AS action, 'fid is taken' AS reason, CAST(1 AS BIGINT) AS features
         FROM walk WHERE rn = 1 AND t_fid IS NULL AND fid IN (SELECT fid FROM fx_target)""",
    "merge_counts": _with("walk") + _counts(*_PLAIN, "false"),
    "merge_compare": _with("walk") + _counts(*_COMPARED, "true"),
    "merge_dry_run_counts": _with("walk")
    + _counts(*_DRY, "false")
    + " UNION ALL "
    + _counts(*_DRY_COMPARED, "true"),
    "merge_geometry": _with("walk_cat")
    + f"""SELECT t.fid, {", ".join(f"CASE WHEN w.t_fid IS NULL THEN t.{c} ELSE w.{c} END AS {c}" for c in _FIELDS)}
          FROM fx_target t LEFT JOIN (SELECT * FROM walk_cat WHERE rd = 1) w ON w.t_fid = t.fid""",
    "merge_geometry_counts": _with("walk_cat")
    + " UNION ALL ".join(
        f"""SELECT {compare} AS compare, {dry_run} AS dry_run, count(*) FILTER (WHERE {updated}) AS updated,
              CAST(0 AS BIGINT) AS appended FROM walk_cat"""
        for compare, dry_run, updated in (
            ("false", "false", "true"),
            ("false", "true", "true"),
            ("true", "false", f"({_MOVED}) OR (rn = 1 AND now IS DISTINCT FROM old)"),
            ("true", "true", "now IS DISTINCT FROM old"),
        )
    ),
    "same_geometries": _with("fx_track_points")
    + """SELECT fid AS fid_a, fid AS fid_b,
           fid % 7 <> 0 AND fid % 5 <> 0 AND (fid % 3 <> 0 OR bool_and(even)) AS same
         FROM (SELECT ogc_fid AS fid, seg_no, count(*) AS n, list((lon, lat) ORDER BY pt_no) = list((lon, lat) ORDER BY pt_no DESC) AS even
               FROM fx_track_points WHERE batch_no = 1 GROUP BY ogc_fid, seg_no)
         GROUP BY fid""",
    "sites_drop_header": _with("fx_sites")
    + "SELECT * FROM fx_sites WHERE store_name IS NULL OR store_name <> 'store_name'",
    "sites_points": _with("fx_sites")
    + f"""SELECT {_SITE_REST}, CAST(longitude AS DOUBLE) AS x, CAST(latitude AS DOUBLE) AS y,
            4326 AS srid
          FROM fx_sites WHERE (store_name IS NULL OR store_name <> 'store_name')
            AND latitude <> '' AND longitude <> ''""",
    "boundary_load": _with("fx_boundaries") + _BOUNDARY,
    "boundary_rejects": _with("fx_boundaries")
    + f"""SELECT CAST(ogc_fid AS BIGINT) AS ogc_fid, CASE WHEN geom_type <> 'MultiPolygon' THEN 'geometry type'
            WHEN srid <> 4326 THEN 'reference system' ELSE 'adm0_code' END AS reason, CAST(1 AS BIGINT) AS features
          FROM fx_boundaries WHERE NOT ({_BOUNDARY_OK})""",
    "boundary_append": _with("fx_boundaries")
    + f"""SELECT level, CAST(ogc_fid + shift AS BIGINT) AS ogc_fid, adm0_name, CAST(adm0_code AS DOUBLE) AS adm0_code, minx
          FROM fx_boundaries, (VALUES (0), (1), (2)) l(level), (VALUES (0), (10)) t(shift)
          WHERE {_BOUNDARY_OK} AND (shift = 0 OR ogc_fid + 10 NOT IN (SELECT ogc_fid FROM fx_boundaries WHERE {_BOUNDARY_OK}))""",
    "layer_bounds_srid": _with("fx_boundaries")
    + f"""SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, CAST(4326 AS INTEGER) AS srid
          FROM fx_boundaries WHERE {_BOUNDARY_OK}""",
    "layer_grid_srid": _with("fx_boundaries")
    + f"""SELECT CAST(r.range * nx + c.range + 1 AS BIGINT) AS cell_id, round(minx + (maxx - minx) / 2 - nx * 0.75 / 2 + c.range * 0.75, 9) AS minx,
            round(miny + (maxy - miny) / 2 - ny * 0.75 / 2 + r.range * 0.75, 9) AS miny, CAST(4326 AS INTEGER) AS srid
          FROM (SELECT *, CAST(trunc((maxx - minx) / 0.75) AS BIGINT) + 1 AS nx, CAST(trunc((maxy - miny) / 0.75) AS BIGINT) + 1 AS ny
                FROM (SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM fx_boundaries WHERE {_BOUNDARY_OK})) f,
            range(0, nx) c, range(0, ny) r""",
    "opened_layer": _with("fx_target") + "SELECT * FROM fx_target",
    "table_from_query": _with("fx_target") + "SELECT cat, count(*) AS features, max(fid) AS last_fid FROM fx_target GROUP BY cat",
    "project_fields": _with("fx_target") + "SELECT code, val FROM fx_target",
    "merge_layouts_differ": _with("walk")
    + f"""SELECT 'compare is ignored: the layouts differ' AS notice, count(*) FILTER (WHERE {_PLAIN[0]["default"]}) AS updated,
            count(*) FILTER (WHERE {_PLAIN[1]["default"]}) AS appended FROM walk""",
    "import_statuses": _with("heads")
    + """SELECT 'whole' AS input, true AS status, count(DISTINCT name) AS names FROM heads WHERE kind IS NOT NULL
         UNION ALL SELECT 'nothing', false, 0""",
    "geojson_table": _with("fx_target")
    + "SELECT fid, code, label, CAST(cat AS BIGINT) AS cat, x, y FROM fx_target",
    "track_import_held": _with("state", "shapes")
    + """SELECT kind, name, CAST(coalesce(ring_points, 0) AS BIGINT) AS points
         FROM state LEFT JOIN shapes USING (batch_no, ogc_fid)""",
    "boundary_filter": _with("fx_boundaries")
    + f"SELECT * FROM ({_BOUNDARY}) WHERE adm0_code = 6",
    "boundary_hectares": _with("fx_boundaries")
    + f"""SELECT ogc_fid, round((({_MX.format("maxx")}) - ({_MX.format("minx")}))
            * (({_MY.format("maxy")}) - ({_MY.format("miny")})) / 10000, 3) AS hectares
          FROM fx_boundaries""",
    "placemark_rows": _with("fx_target")
    + f"""SELECT idx, 'Feature_' || idx AS name, '#exampleStyleMap' AS "styleUrl",
            {_DESCRIPTION} AS description, y || ',' || x AS coordinates
          FROM (SELECT *, row_number() OVER (ORDER BY fid) AS idx FROM fx_target)""",
    "geojson_features": _with("fx_target") + "SELECT fid, code, label, cat, x, y FROM fx_target",
    "layer_rewrite": _with("fx_target")
    + """SELECT fid, code, label, val * 2 AS val, cat, x, y FROM fx_target
         UNION ALL SELECT fid + 5000000, code, label, val * 2, cat, x, y FROM fx_target""",
    "append_by_name": _with("fx_source", "fx_target")
    + """SELECT * FROM fx_target
         UNION ALL SELECT fid, code, NULL, val, cat, x, y FROM fx_source""",
}
