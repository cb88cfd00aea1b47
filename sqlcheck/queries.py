"""Oracle SQL text per registered query key (DuckDB dialect)."""

from __future__ import annotations

from sqlcheck import (access_grid_sql, exposure_grid_sql, grid_sql, hex_edge, pct_expr,
                      priority_grid_sql, RES)
import math

ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


def _r(c: str, n: int, alias: str) -> str:
    return f"round({c}, {n}) AS {alias}"


@oracle("hex_grid")
def _hex_grid():
    s = hex_edge(RES)
    cx = f"({format(s * math.sqrt(3.0), '.17e')} * (CAST(q AS DOUBLE) + CAST(r AS DOUBLE) / 2e0))"
    cy = f"({format(1.5 * s, '.17e')} * CAST(r AS DOUBLE))"
    area = format(3.0 * math.sqrt(3.0) / 2.0 * s * s / 1.0e6, ".17e")
    return (f"SELECT hex_id, {RES} AS resolution, {_r(cx, 3, 'cx')}, {_r(cy, 3, 'cy')}, "
            f"round({area}, 6) AS area_km2, 7 AS n_vertices FROM ({grid_sql()}) g")


@oracle("exposure")
def _exposure():
    return (f"SELECT hex_id, {_r('population', 6, 'population')}, {_r('population_exposed', 6, 'population_exposed')}, "
            f"{_r(pct_expr('population_exposed', 'population'), 6, 'exposure_pct')} FROM ({exposure_grid_sql()}) e")


@oracle("accessibility")
def _accessibility():
    return (f"SELECT hex_id, {_r('nearest_facility_km', 6, 'nearest_facility_km')}, accessibility_class, "
            f"{_r('accessibility_score', 6, 'accessibility_score')} FROM ({access_grid_sql()}) a")


@oracle("priority")
def _priority():
    return (f"SELECT hex_id, {_r('exposure_score', 6, 'exposure_score')}, {_r('priority_score', 6, 'priority_score')}, "
            f"priority_class FROM ({priority_grid_sql()}) p")


@oracle("hazard_pipeline")
def _pipeline():
    return (f"SELECT hex_id, {RES} AS resolution, {_r('cx', 3, 'cx')}, {_r('cy', 3, 'cy')}, "
            f"{_r('population', 6, 'population')}, {_r('population_exposed', 6, 'population_exposed')}, "
            f"{_r(pct_expr('population_exposed', 'population'), 6, 'exposure_pct')}, "
            f"{_r('nearest_facility_km', 6, 'nearest_facility_km')}, accessibility_class, "
            f"{_r('accessibility_score', 6, 'accessibility_score')}, {_r('exposure_score', 6, 'exposure_score')}, "
            f"{_r('priority_score', 6, 'priority_score')}, priority_class FROM ({priority_grid_sql()}) p")


@oracle("nearest_distance")
def _nearest_distance():
    from sqlcheck import nearest_sql
    pts = f"SELECT hex_id, cx, cy FROM ({exposure_grid_sql()}) e WHERE population > 0"
    return f"SELECT hex_id, round(distance_m / 1000e0, 6) AS nearest_facility_km FROM ({nearest_sql(pts)}) n"


# ============================================================================ helpers
from sqlcheck import (FIXTURE_BOX, admin_shape_rings_sql, aligned_sql, admin_rings_sql, inside_sql, contained, d, exposure_cells_sql,  # noqa: E402
                      facilities_lonlat_sql, facilities_utm_sql, flood_cells_sql, grid_vertices_sql,
                      hex_assign_sql, hex_center_exprs, lonlat_sql, nearest_sql, per_hex_sql, places_sql,
                      pop_cells_sql, pop_points_sql, pop_xy_sql, ray_cast_sql, self_cross_sql, shoelace_sql,
                      square_meta_sql, tile_sql, utm_sql, E, N, S, W)

BW, BS, BE, BN = FIXTURE_BOX


def _grid_inside():
    """(hex_id, admin_id) pairs from the grid polyfill (centre in admin ring)."""
    g = grid_sql()
    return g.replace("SELECT DISTINCT hex_id, CAST(split_part(hex_id, '_', 2) AS BIGINT) AS q, "
                     "CAST(split_part(hex_id, '_', 3) AS BIGINT) AS r FROM (", "SELECT hex_id, admin_id FROM (", 1)


# ============================================================================ 2.1

@oracle("scan_table")
def _scan_table():
    return f"SELECT id, round(x, 3) AS x, round(y, 3) AS y FROM ({facilities_utm_sql()}) f WHERE amenity = 'clinic'"


@oracle("sql_query")
def _sql_query():
    return (f"SELECT amenity, count(*) AS n_facilities, min(id) AS first_id, max(id) AS last_id "
            f"FROM ({facilities_utm_sql()}) f WHERE id >= 0 GROUP BY amenity")


@oracle("lake_scan")
def _lake_scan():
    return f"SELECT id, theme, 'place' AS type, theme AS file_theme FROM ({places_sql()}) p"


@oracle("bbox_contained")
def _bbox_contained():
    return f"SELECT id, theme FROM ({places_sql()}) p WHERE {contained(BW, BS, BE, BN)}"


@oracle("lake_limit")
def _lake_limit():
    return f"SELECT id, theme FROM ({places_sql()}) p WHERE {contained(BW, BS, BE, BN)} ORDER BY id LIMIT 100"


@oracle("geojson_features")
def _geojson_features():
    return (f"SELECT id, name, amenity, 'Point' AS geometry_type, round(lon, 9) AS lon, round(lat, 9) AS lat "
            f"FROM ({facilities_lonlat_sql()}) f")


@oracle("layer_scan")
def _layer_scan():
    return "SELECT CAST(n_nationkey AS BIGINT) AS admin_id, n_name AS NAME_3, 'gadm41_COD_3' AS layer FROM nation"


@oracle("raster_cells")
def _raster_cells():
    return f"SELECT row, col, round(value, 6) AS value FROM ({pop_cells_sql()}) c WHERE NOT isnan(value)"


@oracle("raster_cell_xy")
def _raster_cell_xy():
    return f"SELECT row, col, round(lon, 9) AS lon, round(lat, 9) AS lat FROM ({pop_xy_sql()}) c"


@oracle("nearest_no_facilities")
def _nearest_no_facilities():
    return (f"SELECT hex_id, CAST(NULL AS DOUBLE) AS nearest_facility_km, CAST(NULL AS VARCHAR) AS accessibility_class, "
            f"CAST(NULL AS DOUBLE) AS accessibility_score FROM ({grid_sql()}) g")


# ============================================================================ 2.2

@oracle("write_if_absent")
def _write_if_absent():
    return f"SELECT amenity, count(*) AS n_rows FROM ({facilities_lonlat_sql()}) f WHERE amenity = 'clinic' GROUP BY amenity"


@oracle("update_by_key")
def _update_by_key():
    return (f"SELECT g.hex_id, round(coalesce(ph.population, 0e0), 6) AS population, "
            f"round(coalesce(ph.population_exposed, 0e0), 6) AS population_exposed "
            f"FROM ({grid_sql()}) g LEFT JOIN ({per_hex_sql()}) ph USING (hex_id)")


@oracle("update_unmatched")
def _update_unmatched():
    upd = ("SELECT CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_custkey % 3 <> 0 THEN abs(c_acctbal) * "
           "CASE WHEN c_custkey % 8 = 0 THEN 2e0 ELSE 1e0 END END AS score FROM customer WHERE c_custkey % 2 = 0")
    return (f"SELECT CAST(s_suppkey AS BIGINT) AS id, round(coalesce(u.score, s_acctbal), 6) AS score "
            f"FROM supplier LEFT JOIN ({upd}) u ON u.id = s_suppkey")


def _grid_lonlat_vertices():
    pg = f"SELECT hex_id, CAST(split_part(hex_id, '_', 2) AS BIGINT) AS q, CAST(split_part(hex_id, '_', 3) AS BIGINT) AS r FROM ({grid_sql()}) g"
    return lonlat_sql(grid_vertices_sql(pg), "x", "y", "hex_id, i")


@oracle("export_grid")
def _export_grid():
    bb = (f"SELECT hex_id, round(min(lon), 7) AS xmin, round(max(lon), 7) AS xmax, round(min(lat), 7) AS ymin, "
          f"round(max(lat), 7) AS ymax FROM ({_grid_lonlat_vertices()}) v GROUP BY hex_id")
    cen = lonlat_sql(f"SELECT hex_id, cx, cy, priority_class FROM ({priority_grid_sql()}) p", "cx", "cy",
                     "hex_id, priority_class")
    return (f"SELECT c.hex_id, 7 AS n_vertices, round(c.lon, 7) AS lon, round(c.lat, 7) AS lat, b.xmin, b.xmax, "
            f"b.ymin, b.ymax, c.priority_class FROM ({cen}) c JOIN ({bb}) b USING (hex_id)")


@oracle("export_admin")
def _export_admin():
    v = f"SELECT *, unnest(ring) AS v FROM ({admin_shape_rings_sql()}) s"
    return (f"SELECT admin_id, part_id, CAST(count(DISTINCT ring_no) AS INTEGER) AS n_rings, round(min(v.x) FILTER (ring_no = 0), 7) AS xmin, "
            f"round(max(v.x) FILTER (ring_no = 0), 7) AS xmax, round(min(v.y) FILTER (ring_no = 0), 7) AS ymin, "
            f"round(max(v.y) FILTER (ring_no = 0), 7) AS ymax FROM ({v}) v GROUP BY admin_id, part_id")


@oracle("export_geojson")
def _export_geojson():
    return (f"SELECT hex_id, priority_class, 'Polygon' AS geometry_type, 7 AS n_coords "
            f"FROM ({priority_grid_sql()}) p WHERE population > 0")


@oracle("raster_exposed")
def _raster_exposed():
    return (f"SELECT row // 32 AS tile_row, count(*) AS n_cells, "
            f"round(sum(CASE WHEN depth > 0 THEN value ELSE 0e0 END), 6) AS value_sum "
            f"FROM ({exposure_cells_sql()}) c GROUP BY row // 32")


@oracle("raster_blocks")
def _raster_blocks():
    return (f"SELECT row // 32 AS block_row, col // 32 AS block_col, count(*) AS n_cells, round(sum(value), 6) AS value_sum, "
            f"round(min(value), 6) AS value_min, round(max(value), 6) AS value_max FROM ({pop_cells_sql()}) c "
            f"GROUP BY row // 32, col // 32")


@oracle("raster_overview")
def _raster_overview():
    # population counts have six decimals: millionths are summed and divided as integers, halves up
    pop = f"SELECT row, col, CAST(round(value * 1e6) AS BIGINT) AS value FROM ({pop_cells_sql()}) p"
    wet = f"SELECT * FROM ({flood_cells_sql()}) f WHERE value <> 0e0 AND NOT isnan(value)"
    out = []
    for name, cells, avg, one in (("population", pop, "((2 * sum(value) + count(*)) // (2 * count(*)))::BIGINT / 1e6", "value / 1e6"),
                                  ("flood", wet, "round(avg(value), 6)", "round(value, 6)")):
        for level in range(1, 5):
            f = 2 ** level
            out.append(f"SELECT '{name}' AS raster, 'avg' AS how, {level} AS level, row // {f} AS row, col // {f} AS col, "
                       f"{avg} AS value FROM ({cells}) c GROUP BY row // {f}, col // {f}")
            out.append(f"SELECT '{name}' AS raster, 'nearest' AS how, {level} AS level, r AS row, c AS col, {one} AS value "
                       f"FROM (SELECT *, row // {f} AS r, col // {f} AS c, row_number() OVER (PARTITION BY row // {f}, col // {f} "
                       f"ORDER BY row, col) AS rn FROM ({cells}) c) x WHERE rn = 1")
    return " UNION ALL ".join(out)


def _tiles_sql():
    bb = (f"SELECT v.hex_id, min(lon) AS xmin, max(lon) AS xmax, min(lat) AS ymin, max(lat) AS ymax "
          f"FROM ({_grid_lonlat_vertices()}) v JOIN (SELECT hex_id FROM ({exposure_grid_sql()}) e WHERE population > 0) p "
          f"USING (hex_id) GROUP BY v.hex_id")
    x0, y0 = tile_sql("xmin", "ymax", "zoom")
    x1, y1 = tile_sql("xmax", "ymin", "zoom")
    z = f"SELECT *, unnest(range(6, 15)) AS zoom FROM ({bb}) b"      # the 6..14 pyramid
    xr = f"SELECT hex_id, zoom, {x0} AS tx0, {x1} AS tx1, {y0} AS ty0, {y1} AS ty1 FROM ({z}) z"
    return (f"SELECT hex_id, zoom, tile_x, unnest(range(ty0, ty1 + 1)) AS tile_y FROM "
            f"(SELECT *, unnest(range(tx0, tx1 + 1)) AS tile_x FROM ({xr}) a) b")


def _facility_tiles_sql():
    x, y = tile_sql("lon", "lat", "zoom")
    return (f"SELECT zoom, {x} AS tile_x, {y} AS tile_y FROM (SELECT lon, lat, unnest(range(6, 15)) AS zoom "
            f"FROM ({facilities_lonlat_sql()}) f) z")


@oracle("tile_features")
def _tile_features():
    n = " + ".join(f"(CASE WHEN p.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in (
        "population", "population_exposed", "nearest_facility_km", "accessibility_class", "accessibility_score",
        "priority_score", "priority_class"))
    hexes = f"SELECT 'hexagons' AS layer, t.zoom, t.tile_x, t.tile_y, 1 + {n} AS n FROM ({_tiles_sql()}) t JOIN ({priority_grid_sql()}) p USING (hex_id)"
    points = f"SELECT 'facilities' AS layer, zoom, tile_x, tile_y, 2 AS n FROM ({_facility_tiles_sql()}) f"
    return (f"SELECT layer, zoom, tile_x, tile_y, count(*) AS n_features, CAST(sum(n) AS BIGINT) AS n_values "
            f"FROM ({hexes} UNION ALL {points}) u GROUP BY layer, zoom, tile_x, tile_y")


@oracle("tile_thin")
def _tile_thin():
    t = (f"SELECT t.*, p.priority_score FROM ({_tiles_sql()}) t JOIN (SELECT hex_id, priority_score FROM "
         f"({priority_grid_sql()}) pg) p USING (hex_id)")
    return (f"SELECT zoom, tile_x, tile_y, hex_id, tile_rank, greatest(n - 200, 0) AS n_dropped FROM (SELECT *, row_number() "
            f"OVER (PARTITION BY zoom, tile_x, tile_y ORDER BY priority_score DESC, hex_id) AS tile_rank, count(*) OVER "
            f"(PARTITION BY zoom, tile_x, tile_y) AS n FROM ({t}) a) b WHERE tile_rank <= 200")


# ============================================================================ 2.3

def _pg():
    return priority_grid_sql()


@oracle("filter_populated")
def _filter_populated():
    return f"SELECT hex_id, round(population, 6) AS population FROM ({exposure_grid_sql()}) e WHERE population > 0"


@oracle("bbox_points")
def _bbox_points():
    return (f"SELECT id, round(lon, 9) AS lon, round(lat, 9) AS lat FROM ({facilities_lonlat_sql()}) f "
            f"WHERE lon BETWEEN {d(BW)} AND {d(BE)} AND lat BETWEEN {d(BS)} AND {d(BN)}")


@oracle("project_rename")
def _project_rename():
    return (f"SELECT hex_id, round(cx, 3) AS geometry_x, round(cy, 3) AS geometry_y FROM ({exposure_grid_sql()}) e "
            f"WHERE population > 0")


@oracle("map_layer")
def _map_layer():
    return (f"SELECT hex_id, round(population, 6) AS population, round(population_exposed, 6) AS population_exposed, "
            f"round({pct_expr('population_exposed', 'population')}, 6) AS exposure_pct, "
            f"round(nearest_facility_km, 6) AS nearest_facility_km, accessibility_class, "
            f"round(priority_score, 6) AS priority_score, priority_class, 7 AS n_vertices FROM ({_pg()}) p "
            f"WHERE population > 0")


@oracle("grid_columns")
def _grid_columns():
    s = hex_edge(RES)
    area = d(3.0 * math.sqrt(3.0) / 2.0 * s * s / 1.0e6)
    return f"SELECT hex_id, {RES} AS resolution, round({area}, 6) AS area_km2 FROM ({grid_sql()}) g"


@oracle("null_repair")
def _null_repair():
    return (f"SELECT hex_id, round(CASE WHEN population = 0 THEN 1e0 ELSE population END, 6) AS pop_divisor, "
            f"round({pct_expr('population_exposed', 'population')}, 6) AS exposure_pct, "
            f"round(1e0 - coalesce(accessibility_score, 0e0), 6) AS inaccessibility FROM ({_pg()}) p")


@oracle("null_repair_cases")
def _null_repair_cases():
    rows = ("SELECT CAST(c_custkey AS BIGINT) AS id, abs(c_acctbal) + 1e0 AS people, c_custkey % 5 AS p, c_custkey % 3 AS e, "
            "c_custkey % 4 AS s FROM customer")
    # population 0 reads as 1; a NULL or NaN in either makes 0
    return (f"SELECT id, round(CASE WHEN e <> 1 OR p IN (1, 2) THEN 0e0 WHEN p = 0 THEN people / 2e0 * 100e0 "
            f"ELSE people / 2e0 / people * 100e0 END, 6) AS exposure_pct, "
            f"CASE WHEN s IN (0, 1) THEN 1e0 ELSE 0.75e0 END AS inaccessibility, "
            f"round(0.3e0 + CASE WHEN s IN (0, 1) THEN 0.4e0 ELSE 0.75e0 * 0.4e0 END, 6) AS priority_score FROM ({rows}) r")


def _test_rings_sql():
    a = admin_rings_sql()
    moved = "{'x': ring[4].x, 'y': ring[4].y + (ring[4].y - ring[1].y)}"
    bad = (f"CASE admin_id % 5 WHEN 1 THEN ring[1:4] WHEN 2 THEN list_concat(ring[1:2], ring[2:5]) "
           f"WHEN 3 THEN [ring[1], ring[3], ring[2], {moved}, ring[5]] WHEN 4 THEN list_reverse(ring) ELSE ring END")
    return f"SELECT admin_id, {bad} AS ring FROM ({a}) a"


def _validity_sql(rings: str) -> str:
    area = shoelace_sql(rings, "admin_id")
    cross = self_cross_sql(rings, "admin_id")
    return f"""
SELECT t.admin_id, t.ring,
  CASE WHEN NOT (ring[1].x = ring[len(ring)].x AND ring[1].y = ring[len(ring)].y) THEN 'not_closed'
       WHEN len(ring) < 4 THEN 'too_few_points'
       WHEN coalesce(a.cross_sum, 0e0) = 0 THEN 'zero_area'
       WHEN c.admin_id IS NOT NULL THEN 'self_crossing' END AS invalid_reason,
  a.cross_sum
FROM ({rings}) t LEFT JOIN ({area}) a USING (admin_id) LEFT JOIN ({cross}) c ON c.admin_id = t.admin_id
"""


@oracle("geom_valid")
def _geom_valid():
    return (f"SELECT admin_id, invalid_reason IS NULL AS valid, invalid_reason FROM ({_validity_sql(_test_rings_sql())}) v")


@oracle("geom_edge_faults")
def _geom_edge_faults():
    def turn(p, q, r):
        (px, py), (qx, qy), (rx, ry) = ((f"{c[0]}x{c[1]}", f"{c[0]}y{c[1]}") for c in (p, q, r))
        return f"sign(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"

    def within(p, q, r):
        return " AND ".join(f"{r[0]}{d}{r[1]} BETWEEN least({p[0]}{d}{p[1]}, {q[0]}{d}{q[1]}) AND greatest({p[0]}{d}{p[1]}, {q[0]}{d}{q[1]})"
                            for d in "xy")

    def shared(d):
        return (f"greatest(least(a{d}1, b{d}1), least(a{d}2, b{d}2)) < least(greatest(a{d}1, b{d}1), greatest(a{d}2, b{d}2))")

    turns = [("a1", "b1", "a2"), ("a1", "b1", "b2"), ("a2", "b2", "a1"), ("a2", "b2", "b1")]
    dedup = (f"SELECT admin_id, list_filter(ring, lambda p, i: i = 1 OR p.x <> ring[i - 1].x OR p.y <> ring[i - 1].y) "
             f"AS ring FROM ({_test_rings_sql()}) t")
    edges = ("SELECT admin_id, i - 1 AS e, ring[i].x AS ax, ring[i].y AS ay, ring[i + 1].x AS bx, ring[i + 1].y AS by_, "
             "CASE WHEN ring[1].x = ring[len(ring)].x AND ring[1].y = ring[len(ring)].y THEN len(ring) - 2 END AS last "
             f"FROM (SELECT *, unnest(generate_series(1, len(ring) - 1)) AS i FROM ({dedup}) d) u")
    one = lambda s: ", ".join(f"{c} AS {c.rstrip('_')}{s}" for c in ("e", "ax", "ay", "bx", "by_", "last"))
    pairs = (f"SELECT f.*, g.* EXCLUDE (admin_id), {', '.join(f'{turn(*t)} AS o{i}' for i, t in enumerate(turns, 1))} "
             f"FROM (SELECT admin_id, {one(1)} FROM edges) f JOIN (SELECT admin_id, {one(2)} FROM edges) g "
             "ON f.admin_id = g.admin_id AND f.e1 < g.e2")
    meeting = " OR ".join(f"(o{i} = 0 AND {within(*t)})" for i, t in enumerate(turns, 1))
    kind = (f"CASE WHEN e2 = e1 + 1 OR (e1 = 0 AND coalesce(e2 = last1, FALSE)) THEN "
            f"CASE WHEN o1 = 0 AND o2 = 0 AND ({shared('x')} OR {shared('y')}) THEN 'touch' END "
            f"WHEN o1 * o2 < 0 AND o3 * o4 < 0 THEN 'crossing' WHEN {meeting} THEN 'touch' END")
    return (f"WITH edges AS ({edges}), pairs AS ({pairs}), kinds AS (SELECT admin_id, {kind} AS kind FROM pairs), "
            "counts AS (SELECT admin_id, count(*) FILTER (kind = 'crossing') AS c, count(*) FILTER (kind = 'touch') AS t FROM kinds GROUP BY ALL) "
            f"SELECT admin_id, coalesce(c, 0) AS n_crossings, coalesce(t, 0) AS n_touches, 0::BIGINT AS n_overlaps "
            f"FROM (SELECT DISTINCT admin_id FROM ({_test_rings_sql()}) t) z LEFT JOIN counts USING (admin_id)")


@oracle("geom_repair")
def _geom_repair():
    dedup = (f"SELECT admin_id, list_filter(ring, lambda p, i: i = 1 OR p.x <> ring[i - 1].x OR p.y <> ring[i - 1].y) "
             f"AS ring FROM ({_test_rings_sql()}) t")
    closed = (f"SELECT admin_id, CASE WHEN ring[1].x = ring[len(ring)].x AND ring[1].y = ring[len(ring)].y THEN ring "
              f"ELSE list_append(ring, ring[1]) END AS ring FROM ({dedup}) d")
    area = shoelace_sql(closed, "admin_id")
    oriented = (f"SELECT c.admin_id, CASE WHEN a.cross_sum < 0 THEN list_reverse(c.ring) ELSE c.ring END AS ring "
                f"FROM ({closed}) c LEFT JOIN ({area}) a USING (admin_id)")
    v = _validity_sql(oriented)
    return (f"SELECT admin_id, invalid_reason IS NOT NULL AS rejected, CAST(len(ring) AS INTEGER) AS n_points, "
            f"CASE WHEN invalid_reason IS NULL THEN round(cross_sum / 2e0, 9) END AS signed_area FROM ({v}) v")


# ============================================================================ 2.4

def _populated_pts():
    return f"SELECT hex_id, cx, cy FROM ({exposure_grid_sql()}) e WHERE population > 0"


@oracle("nearest_facility")
def _nearest_facility():
    return (f"SELECT hex_id, facility_id, round(distance_m / 1000e0, 6) AS distance_km "
            f"FROM ({nearest_sql(_populated_pts())}) n")


@oracle("knn_facilities")
def _knn_facilities():
    f = facilities_utm_sql()
    return f"""
SELECT hex_id, CAST(rank AS INTEGER) AS rank, id AS facility_id, round(sqrt(d2) / 1000e0, 6) AS distance_km FROM (
  SELECT p.hex_id, f.id, (p.cx - f.x) * (p.cx - f.x) + (p.cy - f.y) * (p.cy - f.y) AS d2,
         row_number() OVER (PARTITION BY p.hex_id ORDER BY (p.cx - f.x) * (p.cx - f.x) + (p.cy - f.y) * (p.cy - f.y), f.id) AS rank
  FROM ({_populated_pts()}) p CROSS JOIN ({f}) f) k WHERE rank <= 3
"""


@oracle("zonal_hex")
def _zonal_hex():
    u = utm_sql(pop_xy_sql(), "lon", "lat", "value")
    h = hex_assign_sql(u, "x", "y", "value")
    return f"SELECT hex_id, round(sum(value), 6) AS population, count(*) AS n_cells FROM ({h}) h GROUP BY hex_id"


def _admin_utm_rings():
    verts = (f"SELECT admin_id, i, ring[i].x AS lon, ring[i].y AS lat FROM (SELECT admin_id, ring, "
             f"unnest(range(1, len(ring) + 1)) AS i FROM ({admin_rings_sql()}) a) v")
    u = utm_sql(verts, "lon", "lat", "admin_id, i")
    return f"SELECT admin_id, list({{'x': x, 'y': y}} ORDER BY i) AS ring FROM ({u}) u GROUP BY admin_id"


def _shape_utm_vertices():
    """(admin_id, part_id, pid, ring_no, i, x, y): vertices of the shaped units, projected."""
    verts = (f"SELECT admin_id, part_id, pid, ring_no, i, ring[i].x AS lon, ring[i].y AS lat FROM (SELECT *, "
             f"unnest(range(1, len(ring) + 1)) AS i FROM ({admin_shape_rings_sql()}) a) v")
    return utm_sql(verts, "lon", "lat", "admin_id, part_id, pid, ring_no, i")


@oracle("zonal_polygon")
def _zonal_polygon():
    pts = utm_sql(pop_points_sql(), "lon", "lat", "pid, weight")
    rings = f"SELECT pid AS zid, list({{'x': x, 'y': y}} ORDER BY i) AS ring FROM ({_shape_utm_vertices()}) u GROUP BY pid, ring_no"
    cand = f"SELECT p.pid, p.x, p.y, a.zid FROM ({pts}) p CROSS JOIN (SELECT DISTINCT zid FROM ({rings}) r) a"
    inside = ray_cast_sql(cand, rings, "pid", "x", "y", "zid")
    return (f"SELECT i.zid // 10 AS admin_id, round(sum(p.weight), 6) AS value_sum, count(*) AS n_points FROM ({inside}) i "
            f"JOIN ({pop_points_sql()}) p USING (pid) GROUP BY i.zid // 10")


@oracle("raster_align")
def _raster_align():
    return f"SELECT row, col, round(depth, 6) AS depth FROM ({aligned_sql()}) a"


@oracle("clip_to_box")
def _clip_to_box():
    b = (f"SELECT admin_id, greatest(ring[1].x, {d(BW)}) AS w, least(ring[2].x, {d(BE)}) AS e, "
         f"greatest(ring[1].y, {d(BS)}) AS s, least(ring[3].y, {d(BN)}) AS n FROM ({admin_rings_sql()}) a")
    return (f"SELECT admin_id, round((e - w) * (n - s), 9) AS area, round(w, 9) AS xmin, round(e, 9) AS xmax, "
            f"round(s, 9) AS ymin, round(n, 9) AS ymax FROM ({b}) b WHERE w < e AND s < n")


def _shape_inside():
    """(hex_id, admin_id) of the shaped units (parts and holes)."""
    rings = f"SELECT pid AS admin_id, ring FROM ({admin_shape_rings_sql()}) s"
    return f"SELECT hex_id, admin_id // 10 AS admin_id FROM ({inside_sql(rings)}) i"


@oracle("hex_admin")
def _hex_admin():
    return f"SELECT hex_id, admin_id FROM ({_shape_inside()}) s JOIN (SELECT hex_id FROM ({grid_sql()}) g) g USING (hex_id)"


@oracle("hex_polyfill")
def _hex_polyfill():
    return f"SELECT DISTINCT admin_id, hex_id FROM ({_shape_inside()}) g"


@oracle("hex_polyfill_multi")
def _hex_polyfill_multi():
    return f"SELECT DISTINCT hex_id FROM ({_shape_inside()}) g"


# ============================================================================ 2.5

@oracle("minmax_normalize")
def _minmax_normalize():
    return f"SELECT hex_id, round(exposure_score, 6) AS exposure_score FROM ({_pg()}) p WHERE population > 0"


@oracle("score_percentiles")
def _score_percentiles():
    q = (100.0 - 10.0) / 100.0
    return (f"SELECT round(quantile_cont(priority_score, {d(q)}), 9) AS p_high, "
            f"round(quantile_cont(priority_score, {d(0.5)}), 9) AS p_mid FROM ({_pg()}) p WHERE population > 0")


@oracle("population_totals")
def _population_totals():
    hp = "sum(CASE WHEN priority_class = 'high' THEN population ELSE 0e0 END)"
    return (f"SELECT round(sum(population), 6) AS total_population, round(sum(population_exposed), 6) AS exposed_population, "
            f"round({hp}, 6) AS high_priority_population, "
            f"round({hp} / nullif(sum(population), 0) * 100e0, 6) AS high_priority_pct FROM ({_pg()}) p")


@oracle("class_counts")
def _class_counts():
    return (f"SELECT priority_class, count(*) AS n_hexes FROM ({_pg()}) p WHERE priority_class IS NOT NULL "
            f"GROUP BY priority_class")


@oracle("access_summary")
def _access_summary():
    return (f"SELECT round(avg(nearest_facility_km), 6) AS avg_distance_km, "
            f"count(*) FILTER (WHERE nearest_facility_km > {d(10.0)}) AS n_poor_access, count(*) AS n_hexes "
            f"FROM ({access_grid_sql()}) a WHERE nearest_facility_km IS NOT NULL")


@oracle("run_summary")
def _run_summary():
    return (f"SELECT count(*) AS total_hexes, round(sum(population), 6) AS total_population, "
            f"round(sum(population_exposed), 6) AS exposed_population, "
            f"count(*) FILTER (WHERE priority_class = 'high') AS high_priority_hexes, "
            f"round(avg(nearest_facility_km), 6) AS avg_facility_distance_km FROM ({_pg()}) p")


@oracle("table_count")
def _table_count():
    return (f"SELECT 'admin_boundaries' AS table_name, (SELECT count(*) FROM nation) AS n_rows "
            f"UNION ALL SELECT 'health_facilities', (SELECT count(*) FROM supplier) "
            f"UNION ALL SELECT 'h3_grid', (SELECT count(*) FROM ({grid_sql()}) g) "
            f"UNION ALL SELECT 'population_cells', (SELECT count(*) FROM orders) "
            f"UNION ALL SELECT 'no_rows', CAST(0 AS BIGINT)")


@oracle("layer_extent")
def _layer_extent():
    a = f"SELECT v.x AS x, v.y AS y FROM (SELECT unnest(ring) AS v FROM ({admin_rings_sql()}) r) u"
    return (f"SELECT round(min(x), 9) AS xmin, round(min(y), 9) AS ymin, round(max(x), 9) AS xmax, "
            f"round(max(y), 9) AS ymax FROM ({a}) a")


@oracle("admin_rollup")
def _admin_rollup():
    t = (f"SELECT p.*, a.NAME_0, a.NAME_3 FROM ({_pg()}) p JOIN ({_grid_inside()}) h USING (hex_id) "
         f"JOIN ({admin_rings_sql()}) a ON a.admin_id = h.admin_id")
    wd = "sum(CASE WHEN nearest_facility_km IS NOT NULL THEN population * nearest_facility_km END)"
    wp = "sum(CASE WHEN nearest_facility_km IS NOT NULL THEN population END)"
    return (f"SELECT NAME_0, NAME_3, count(*) AS n_hexes, round(sum(population), 6) AS population, "
            f"round(sum(population_exposed), 6) AS population_exposed, round({wd} / nullif({wp}, 0), 6) AS weighted_distance_km, "
            f"count(*) FILTER (WHERE priority_class = 'high') AS high_priority_hexes FROM ({t}) t "
            f"GROUP BY ROLLUP (NAME_0, NAME_3)")


@oracle("hex_parent_rollup")
def _hex_parent_rollup():
    h = hex_assign_sql(exposure_grid_sql(), "cx", "cy", "population, population_exposed", res=RES - 1, out="parent_id")
    return (f"SELECT parent_id, count(*) AS n_children, round(sum(population), 6) AS population, "
            f"round(sum(population_exposed), 6) AS population_exposed FROM ({h}) h GROUP BY parent_id")


# ============================================================================ 2.6

@oracle("first_n")
def _first_n():
    return ("(SELECT 'admin' AS kind, CAST(n_nationkey AS BIGINT) AS id FROM nation ORDER BY n_nationkey LIMIT 1) "
            "UNION ALL (SELECT 'facility' AS kind, CAST(s_suppkey AS BIGINT) AS id FROM supplier ORDER BY s_suppkey LIMIT 5)")


@oracle("top_priority")
def _top_priority():
    return f"SELECT hex_id, round(priority_score, 6) AS priority_score FROM ({_pg()}) p WHERE priority_class = 'high'"


# ============================================================================ 2.7

@oracle("to_utm")
def _to_utm():
    return f"SELECT pid, round(x, 3) AS x, round(y, 3) AS y FROM ({utm_sql(pop_points_sql(), 'lon', 'lat', 'pid')}) u"


@oracle("to_lonlat")
def _to_lonlat():
    ll = lonlat_sql(facilities_utm_sql(), "x", "y", "id")
    return f"SELECT id, round(lon, 9) AS lon, round(lat, 9) AS lat FROM ({ll}) l"


def _shape_moments():
    """Per part: area (holes off) and first moments, from the rings' own."""
    v = _shape_utm_vertices()
    e = (f"SELECT a.admin_id, a.part_id, a.ring_no, a.x, a.y, b.x AS nx, b.y AS ny FROM ({v}) a JOIN ({v}) b "
         f"ON a.pid = b.pid AND a.ring_no = b.ring_no AND b.i = a.i + 1")
    cr = "(x * ny - nx * y)"
    rings = (f"SELECT admin_id, part_id, CASE WHEN ring_no = 0 THEN 1e0 ELSE -1e0 END * abs(sum({cr}) / 2e0) AS w, "
             f"sum((x + nx) * {cr}) / (sum({cr}) / 2e0 * 6e0) AS cx, sum((y + ny) * {cr}) / (sum({cr}) / 2e0 * 6e0) AS cy "
             f"FROM ({e}) e GROUP BY admin_id, part_id, ring_no")
    return (f"SELECT admin_id, part_id, sum(w) AS area, sum(w * cx) / sum(w) AS cx, sum(w * cy) / sum(w) AS cy "
            f"FROM ({rings}) r GROUP BY admin_id, part_id")


@oracle("polygon_area")
def _polygon_area():
    return f"SELECT admin_id, part_id, round(area / 1e6, 6) AS area_km2 FROM ({_shape_moments()}) m"


@oracle("polygon_centroid")
def _polygon_centroid():
    return f"SELECT admin_id, part_id, round(cx, 3) AS cx, round(cy, 3) AS cy FROM ({_shape_moments()}) m"


@oracle("polygon_wkt")
def _polygon_wkt():
    pt = "printf('%.7f', ring[i].x) || ' ' || printf('%.7f', ring[i].y)"
    rings = (f"SELECT admin_id, part_id, ring_no, '(' || string_agg({pt}, ', ' ORDER BY i) || ')' AS t FROM (SELECT *, "
             f"unnest(range(1, len(ring) + 1)) AS i FROM ({admin_shape_rings_sql()}) a) v GROUP BY admin_id, part_id, ring_no")
    return (f"SELECT admin_id, part_id, 'SRID=4326;POLYGON(' || string_agg(t, ', ' ORDER BY ring_no) || ')' AS wkt, "
            f"count(*) AS n_rings FROM ({rings}) r GROUP BY admin_id, part_id")


@oracle("hex_wkt")
def _hex_wkt():
    pg = (f"SELECT hex_id, CAST(split_part(hex_id, '_', 2) AS BIGINT) AS q, "
          f"CAST(split_part(hex_id, '_', 3) AS BIGINT) AS r FROM ({grid_sql()}) g")
    cx, cy = hex_center_exprs("q", "r")
    body = (f"SELECT hex_id, 'SRID=32735;POLYGON((' || string_agg(printf('%.3f', x) || ' ' || printf('%.3f', y), ', ' ORDER BY i) || '))' "
            f"AS geometry_wkt FROM ({grid_vertices_sql(pg)}) v GROUP BY hex_id")
    return (f"SELECT b.hex_id, geometry_wkt, 'SRID=32735;POINT(' || printf('%.3f', {cx}) || ' ' || printf('%.3f', {cy}) || ')' "
            f"AS centroid_wkt FROM ({body}) b JOIN ({pg}) g ON b.hex_id = g.hex_id")


@oracle("distance_km")
def _distance_km():
    h = hex_assign_sql(facilities_utm_sql(), "x", "y", "id, x, y", keep_qr=True)
    cx, cy = hex_center_exprs("q", "r")
    return (f"SELECT id, hex_id, round(sqrt((x - {cx}) * (x - {cx}) + (y - {cy}) * (y - {cy})) / 1000e0, 6) AS distance_km "
            f"FROM ({h}) h")


@oracle("box_ring")
def _box_ring():
    b = f"SELECT admin_id, ring[1].x AS xmin, ring[1].y AS ymin, ring[3].x AS xmax, ring[3].y AS ymax FROM ({admin_rings_sql()}) a"
    pts = ("CASE i WHEN 0 THEN xmin WHEN 1 THEN xmax WHEN 2 THEN xmax WHEN 3 THEN xmin ELSE xmin END",
           "CASE i WHEN 0 THEN ymin WHEN 1 THEN ymin WHEN 2 THEN ymax WHEN 3 THEN ymax ELSE ymin END")
    return (f"SELECT admin_id, CAST(i AS INTEGER) AS i, round({pts[0]}, 9) AS x, round({pts[1]}, 9) AS y "
            f"FROM (SELECT *, unnest(range(0, 5)) AS i FROM ({b}) b) p")


@oracle("hex_assign")
def _hex_assign():
    u = utm_sql(pop_points_sql(), "lon", "lat", "pid")
    return f"SELECT pid, hex_id FROM ({hex_assign_sql(u, 'x', 'y', 'pid')}) h"


@oracle("hex_boundary")
def _hex_boundary():
    pg = (f"SELECT hex_id, CAST(split_part(hex_id, '_', 2) AS BIGINT) AS q, "
          f"CAST(split_part(hex_id, '_', 3) AS BIGINT) AS r FROM ({grid_sql()}) g")
    return (f"SELECT hex_id, CAST(i AS INTEGER) AS i, round(x, 3) AS x, round(y, 3) AS y "
            f"FROM ({grid_vertices_sql(pg)}) v")


@oracle("to_wkt")
def _to_wkt():
    return (f"SELECT id, 'SRID=32735;POINT(' || printf('%.3f', x) || ' ' || printf('%.3f', y) || ')' AS wkt "
            f"FROM ({facilities_utm_sql()}) f")


@oracle("from_wkt")
def _from_wkt():
    return (f"SELECT id, 32735 AS srid, CAST(printf('%.3f', x) AS DOUBLE) AS x, CAST(printf('%.3f', y) AS DOUBLE) AS y "
            f"FROM ({facilities_utm_sql()}) f")


@oracle("point_in_ring")
def _point_in_ring():
    a = f"SELECT pid AS zid, ring FROM ({admin_shape_rings_sql()}) s"
    cand = f"SELECT p.pid, p.lon, p.lat, a.zid FROM ({pop_points_sql()}) p CROSS JOIN (SELECT DISTINCT zid FROM ({a}) x) a"
    return f"SELECT pid, zid // 10 AS admin_id FROM ({ray_cast_sql(cand, a, 'pid', 'lon', 'lat', 'zid')}) i"


@oracle("flood_mask")
def _flood_mask():
    return (f"SELECT row, col, round(CASE WHEN depth > 0 THEN value ELSE 0e0 END, 6) AS exposed "
            f"FROM ({exposure_cells_sql()}) c")


@oracle("exposure_pct")
def _exposure_pct():
    return (f"SELECT hex_id, round({pct_expr('population_exposed', 'population')}, 6) AS exposure_pct "
            f"FROM ({exposure_grid_sql()}) e")


@oracle("access_class")
def _access_class():
    return f"SELECT hex_id, accessibility_class FROM ({access_grid_sql()}) a WHERE population > 0"


@oracle("access_score")
def _access_score():
    return (f"SELECT hex_id, round(accessibility_score, 6) AS accessibility_score FROM ({access_grid_sql()}) a "
            f"WHERE population > 0")


@oracle("priority_score")
def _priority_score():
    return (f"SELECT hex_id, round(1e0 - coalesce(accessibility_score, 0e0), 6) AS inaccessibility, "
            f"round(priority_score, 6) AS priority_score FROM ({_pg()}) p WHERE population > 0")


@oracle("priority_class")
def _priority_class():
    return f"SELECT hex_id, priority_class FROM ({_pg()}) p WHERE population > 0"


@oracle("raster_clip")
def _raster_clip():
    m = square_meta_sql("orders")
    win = (f"SELECT greatest(0, CAST(ceil(({d(BW)} - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c0, "
           f"least(w - 1, CAST(floor(({d(BE)} - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c1, "
           f"greatest(0, CAST(ceil(({d(N)} - {d(BN)}) / dy - 0.5e0) AS BIGINT)) AS r0, "
           f"least(h - 1, CAST(floor(({d(N)} - {d(BS)}) / dy - 0.5e0) AS BIGINT)) AS r1 FROM ({m}) m")
    return (f"SELECT row - r0 AS row, col - c0 AS col, round(value, 6) AS value FROM ({pop_cells_sql()}) c, ({win}) w "
            f"WHERE row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1")


@oracle("raster_clip_zones")
def _raster_clip_zones():
    rings = f"SELECT admin_id, ring FROM ({admin_shape_rings_sql()}) s"
    edges = f"SELECT admin_id, ring[i] AS a, ring[i + 1] AS b FROM (SELECT admin_id, ring, unnest(range(1, len(ring))) AS i FROM ({rings}) _r) _i"
    box = f"SELECT admin_id, min(a.x) AS w, max(a.x) AS e, min(a.y) AS s, max(a.y) AS n FROM ({edges}) _e GROUP BY admin_id"
    win = (f"SELECT admin_id, greatest(0, CAST(ceil((b.w - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c0, "
           f"least(m.w - 1, CAST(floor((b.e - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c1, "
           f"greatest(0, CAST(ceil(({d(N)} - b.n) / dy - 0.5e0) AS BIGINT)) AS r0, "
           f"least(m.h - 1, CAST(floor(({d(N)} - b.s) / dy - 0.5e0) AS BIGINT)) AS r1 FROM ({box}) b, ({square_meta_sql('orders')}) m")
    inside = (f"SELECT e.admin_id, c.row, c.col, c.value FROM ({pop_xy_sql()}) c JOIN ({edges}) e ON (e.a.y > c.lat) <> (e.b.y > c.lat) "
              f"AND c.lon < (e.b.x - e.a.x) * (c.lat - e.a.y) / (e.b.y - e.a.y) + e.a.x "
              f"GROUP BY e.admin_id, c.row, c.col, c.value HAVING count(*) % 2 = 1")
    return (f"SELECT admin_id, row - r0 AS row, col - c0 AS col, r1 - r0 + 1 AS n_rows, c1 - c0 + 1 AS n_cols, round(value, 6) AS value "
            f"FROM ({inside}) i JOIN ({win}) w USING (admin_id)")


@oracle("raster_pyramid")
def _raster_pyramid():
    out = []
    for level in range(5):
        f = 2 ** level
        cells = (f"SELECT row // {f} AS row, col // {f} AS col, arg_min(value, row * 4294967296 + col) AS value "
                 f"FROM ({pop_cells_sql()}) c GROUP BY row // {f}, col // {f}")
        out.append(f"SELECT {level} AS level, CAST(ceil(m.h / {d(f)}) AS BIGINT) AS n_rows, CAST(ceil(m.w / {d(f)}) AS BIGINT) AS n_cols, "
                   f"row // 16 AS tile_row, col // 16 AS tile_col, count(*) AS n_cells, round(sum(value), 6) AS value_sum "
                   f"FROM ({cells}) c, ({square_meta_sql('orders')}) m GROUP BY ALL")
    return " UNION ALL ".join(out)


@oracle("raster_bilinear")
def _raster_bilinear():
    pm, fm = square_meta_sql("orders"), square_meta_sql("customer")
    t = (f"SELECT id // fm.w AS row, id % fm.w AS col, {d(W)} + (CAST(id % fm.w AS DOUBLE) + 0.5e0) * fm.dx AS tx, "
         f"{d(N)} - (CAST(id // fm.w AS DOUBLE) + 0.5e0) * fm.dy AS ty FROM ({fm}) fm, range(0, fm.w * fm.h) r(id)")
    f = (f"SELECT row, col, (tx - {d(W)}) / pm.dx - 0.5e0 AS fc, ({d(N)} - ty) / pm.dy - 0.5e0 AS fr "
         f"FROM ({t}) t, ({pm}) pm")
    k = (f"SELECT row, col, fc, fr, floor(fc) AS c0, floor(fr) AS r0, dr, dc FROM ({f}) f, "
         f"(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) k(dr, dc)")
    wt = (f"SELECT row, col, CAST(r0 AS BIGINT) + dr AS srow, CAST(c0 AS BIGINT) + dc AS scol, "
          f"(CASE WHEN dc = 1 THEN fc - c0 ELSE 1e0 - (fc - c0) END) * (CASE WHEN dr = 1 THEN fr - r0 ELSE 1e0 - (fr - r0) END) AS w "
          f"FROM ({k}) k")
    j = f"SELECT wt.row, wt.col, wt.w, s.value FROM ({wt}) wt JOIN ({pop_cells_sql()}) s ON s.row = wt.srow AND s.col = wt.scol"
    return (f"SELECT row, col, round(sum(w * value) / sum(w), 9) AS value FROM ({j}) j GROUP BY row, col "
            f"HAVING sum(w) > 0")


@oracle("raster_nearest")
def _raster_nearest():
    fm = square_meta_sql("customer")
    bounds = f"SELECT {d(W)} AS w, {d(N)} - h * dy AS s, {d(W)} + w * dx AS e, {d(N)} AS n, w AS nc, h AS nr, dx AS sdx, dy AS sdy FROM ({fm}) m"
    pts = (f"SELECT b.w + fx * (b.e - b.w) AS lon, b.s + fy * (b.n - b.s) AS lat FROM ({bounds}) b, "
           f"(VALUES (0e0), (0.5e0), (1e0)) a(fx), (VALUES (0e0), (0.5e0), (1e0)) c(fy)")
    u = utm_sql(pts, "lon", "lat", "")
    dm = (f"SELECT min(x) AS w, min(y) AS s, max(x) AS e, max(y) AS n FROM ({u}) u")
    meta = (f"SELECT dm.w AS x0, dm.n AS y0, (dm.e - dm.w) / b.nc AS dx, (dm.n - dm.s) / b.nr AS dy, b.nc, b.nr, "
            f"b.sdx, b.sdy FROM ({dm}) dm, ({bounds}) b")
    t = (f"SELECT id // m.nc AS row, id % m.nc AS col, m.x0 + (CAST(id % m.nc AS DOUBLE) + 0.5e0) * m.dx AS x, "
         f"m.y0 - (CAST(id // m.nc AS DOUBLE) + 0.5e0) * m.dy AS y, m.sdx, m.sdy FROM ({meta}) m, range(0, m.nc * m.nr) r(id)")
    ll = lonlat_sql(t, "x", "y", "row, col, sdx, sdy")
    src = (f"SELECT row, col, CAST(floor(({d(N)} - lat) / sdy) AS BIGINT) AS srow, "
           f"CAST(floor((lon - {d(W)}) / sdx) AS BIGINT) AS scol FROM ({ll}) l")
    return (f"SELECT s.row, s.col, round(f.value, 6) AS value FROM ({src}) s JOIN ({flood_cells_sql()}) f "
            f"ON f.row = s.srow AND f.col = s.scol WHERE f.value <> 0e0 AND NOT isnan(f.value)")


@oracle("raster_valid")
def _raster_valid():
    return (f"SELECT row, col, round(value, 6) AS value FROM ({flood_cells_sql()}) f "
            f"WHERE value <> 0e0 AND NOT isnan(value)")


@oracle("exposure_bins")
def _exposure_bins():
    b = ("CASE WHEN population_exposed >= 200 THEN '200+' WHEN population_exposed >= 100 THEN '100-200' "
         "WHEN population_exposed >= 50 THEN '50-100' WHEN population_exposed >= 10 THEN '10-50' ELSE '0-10' END")
    return (f"SELECT {b} AS exposure_bin, count(*) AS n_hexes FROM ({exposure_grid_sql()}) e WHERE population > 0 "
            f"GROUP BY 1")


@oracle("hex_popup")
def _hex_popup():
    pct = pct_expr("population_exposed", "population")
    return (f"SELECT hex_id, printf('%d', CAST(round(coalesce(population, 0e0)) AS BIGINT)) AS population_text, "
            f"printf('%d', CAST(round(coalesce(population_exposed, 0e0)) AS BIGINT)) || ' (' || "
            f"printf('%.1f', coalesce({pct}, 0e0)) || '%)' AS exposed_text, "
            f"printf('%.2f', coalesce(nearest_facility_km, 0e0)) || ' km' AS facility_text, "
            f"coalesce(accessibility_class, 'N/A') AS accessibility_text, "
            f"coalesce(priority_class, 'N/A') || ' (' || printf('%.3f', coalesce(priority_score, 0e0)) || ')' AS priority_text "
            f"FROM ({_pg()}) p")


@oracle("facility_popup")
def _facility_popup():
    return (f"SELECT id, coalesce(CASE WHEN id % 7 = 0 THEN NULL ELSE name END, 'Unnamed') AS name_text, "
            f"coalesce(amenity, 'Health facility') AS type_text FROM ({facilities_lonlat_sql()}) f")


@oracle("parse_epsg")
def _parse_epsg():
    return f"SELECT id, CAST(32701 + id % 60 AS INTEGER) AS srid FROM ({facilities_lonlat_sql()}) f"


@oracle("tile_xy")
def _tile_xy():
    x, y = tile_sql("lon", "lat", "12")
    return f"SELECT id, {x} AS tile_x, {y} AS tile_y FROM ({facilities_lonlat_sql()}) f"


# ============================================================================ 2.8

@oracle("admin_prepare")
def _admin_prepare():
    b = (f"SELECT admin_id, NAME_3, greatest(ring[1].x, {d(W)}) AS w, least(ring[2].x, {d(E)}) AS e, "
         f"greatest(ring[1].y, {d(S)}) AS s, least(ring[3].y, {d(N)}) AS n FROM ({admin_rings_sql()}) a")
    corners = (f"SELECT admin_id, i, CASE WHEN i IN (0, 3) THEN w ELSE e END AS lon, "
               f"CASE WHEN i IN (0, 1) THEN s ELSE n END AS lat FROM (SELECT *, unnest(range(0, 4)) AS i "
               f"FROM ({b}) b WHERE w < e AND s < n) c")
    u = utm_sql(corners, "lon", "lat", "admin_id, i")
    pairs = (f"SELECT a.admin_id, a.x, a.y, b.x AS nx, b.y AS ny FROM ({u}) a JOIN ({u}) b "
             f"ON a.admin_id = b.admin_id AND b.i = (a.i + 1) % 4")
    area = f"SELECT admin_id, abs(sum(x * ny - nx * y) / 2e0) AS area FROM ({pairs}) p GROUP BY admin_id"
    return (f"SELECT admin_id, NAME_3, CAST(NULL AS VARCHAR) AS invalid_reason, round(area / 1e6, 6) AS area_km2 FROM ({area}) a "
            f"JOIN (SELECT admin_id, NAME_3 FROM ({admin_rings_sql()}) x) n USING (admin_id)")


@oracle("population_prepare")
def _population_prepare():
    m = square_meta_sql("orders")
    win = (f"SELECT greatest(0, CAST(ceil(({d(W)} - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c0, "
           f"least(w - 1, CAST(floor(({d(E)} - {d(W)}) / dx - 0.5e0) AS BIGINT)) AS c1, "
           f"greatest(0, CAST(ceil(({d(N)} - {d(N)}) / dy - 0.5e0) AS BIGINT)) AS r0, "
           f"least(h - 1, CAST(floor(({d(N)} - {d(S)}) / dy - 0.5e0) AS BIGINT)) AS r1, dx, dy FROM ({m}) m")
    cells = (f"SELECT row - r0 AS row, col - c0 AS col, value, "
             f"({d(W)} + CAST(c0 AS DOUBLE) * dx) + (CAST(col - c0 AS DOUBLE) + 0.5e0) * dx AS lon, "
             f"({d(N)} - CAST(r0 AS DOUBLE) * dy) - (CAST(row - r0 AS DOUBLE) + 0.5e0) * dy AS lat "
             f"FROM ({pop_cells_sql()}) c, ({win}) w WHERE row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1")
    u = utm_sql(cells, "lon", "lat", "row, col, value")
    return f"SELECT row, col, round(value, 6) AS value, round(x, 3) AS x, round(y, 3) AS y FROM ({u}) u"


@oracle("facility_prepare")
def _facility_prepare():
    f = (f"SELECT * FROM ({facilities_lonlat_sql()}) f WHERE lon BETWEEN {d(W)} AND {d(E)} "
         f"AND lat BETWEEN {d(S)} AND {d(N)}")
    u = utm_sql(f, "lon", "lat", "id, name, amenity")
    return f"SELECT id, name, amenity, round(x, 3) AS x, round(y, 3) AS y FROM ({u}) u"


@oracle("lake_theme_prepare")
def _lake_theme_prepare():
    p = f"SELECT id, theme, lon, lat FROM ({places_sql()}) p WHERE {contained(W, S, E, N)}"
    u = utm_sql(p, "lon", "lat", "id, theme")
    return (f"SELECT theme, count(*) AS n_features, round(min(x), 3) AS xmin, round(max(x), 3) AS xmax "
            f"FROM ({u}) u GROUP BY theme")


@oracle("lake_shapes")
def _lake_shapes():
    p = f"SELECT id, xmin, xmax, ymin, ymax FROM ({places_sql()}) p WHERE {contained(W, S, E, N)}"
    corners = (f"SELECT id, i, CASE WHEN i IN (0, 3) THEN xmin ELSE xmax END AS lon, CASE WHEN i IN (0, 1) THEN ymin ELSE ymax END AS lat "
               f"FROM (SELECT *, unnest(range(0, 4)) AS i FROM ({p}) p) c")
    u = utm_sql(corners, "lon", "lat", "id, i")
    area = (f"SELECT a.id, abs(sum((a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y)) / 2e0) AS area FROM ({u}) a JOIN ({u}) b "
            f"ON a.id = b.id AND b.i = (a.i + 1) % 4 JOIN ({u}) o ON o.id = a.id AND o.i = 0 GROUP BY a.id")
    length = f"SELECT a.id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS l FROM ({u}) a JOIN ({u}) b ON a.id = b.id AND a.i = 0 AND b.i = 2"
    return (f"SELECT 'buildings' AS theme, 'POLYGON' AS geometry_type, count(*) AS n_features, round(sum(area), 1) AS area_m2, "
            f"CAST(NULL AS DOUBLE) AS length_m FROM ({area}) a UNION ALL SELECT 'transportation', 'LINESTRING', count(*), "
            f"CAST(NULL AS DOUBLE), round(sum(l), 3) FROM ({length}) l")


@oracle("theme_count_by_hex")
def _theme_count_by_hex():
    p = f"SELECT id, lon, lat FROM ({places_sql()}) p WHERE {contained(W, -4.5, 29.1, N)}"
    u = utm_sql(p, "lon", "lat", "id")
    h = hex_assign_sql(u, "x", "y", "id")
    return (f"SELECT g.hex_id, count(h.id) AS n_places FROM (SELECT hex_id FROM ({grid_sql()}) g) g LEFT JOIN ({h}) h "
            f"USING (hex_id) GROUP BY g.hex_id")


# ============================================================================ 2.9

def _road_sql(table="supplier", key="s_suppkey", shift=""):
    from sqlcheck import key_lat, key_lon
    k = f"({key}{shift})"
    seg = (f"SELECT CAST({key} AS BIGINT) AS id, {key_lon(k)} AS lon0, {key_lat(k)} AS lat0, "
           f"{key_lon(f'({k} + 1)')} AS lon1, {key_lat(f'({k} + 1)')} AS lat1 FROM {table}")
    a = utm_sql(seg, "lon0", "lat0", "id, lon1, lat1", "x0", "y0")
    b = utm_sql(a, "lon1", "lat1", "id, x0, y0", "x1", "y1")

    def node(x, y):
        return (f"CAST(CAST(round({x} / 1e-3) AS BIGINT) AS VARCHAR) || '_' || "
                f"CAST(CAST(round({y} / 1e-3) AS BIGINT) AS VARCHAR)")
    return (f"SELECT id, {node('x0', 'y0')} AS source, {node('x1', 'y1')} AS target, "
            f"sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1)) AS length_m FROM ({b}) e")


@oracle("road_edges")
def _road_edges():
    return f"SELECT id, source, target, round(length_m, 3) AS length_m FROM ({_road_sql()}) e"


def _far_road_nodes(cost="length_m"):
    """(j, node, c, x, y) of the chain over customers, half a key further: node j at cumulative length c."""
    e = _road_sql("customer", "c_custkey", " + 0.5e0").replace("SELECT id, ", "SELECT id, x0, y0, x1, y1, ", 1)
    cum = (f"SELECT *, coalesce(sum({cost}) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS c0 "
           f"FROM ({e}) e")
    return (f"SELECT id AS j, source AS node, c0 AS c, x0 AS x, y0 AS y FROM ({cum}) a UNION ALL "
            f"SELECT id + 1 AS j, target AS node, c0 + {cost} AS c, x1 AS x, y1 AS y FROM ({cum}) b WHERE id = (SELECT max(id) FROM ({e}) m)")


@oracle("network_distance")
def _network_distance():
    # every supplier's road start is a source; lengths in whole millimetres
    return (f"WITH n AS ({_far_road_nodes('round(length_m * 1000e0)')}) SELECT n.node, min(abs(n.c - s.c)) / 1000e0 AS dist_m "
            f"FROM n, (SELECT n.c FROM n JOIN supplier ON j = s_suppkey WHERE j < (SELECT max(j) FROM n)) s GROUP BY n.node")


@oracle("network_access")
def _network_access():
    from sqlcheck import access_class_expr, facilities_utm_sql
    far = "sqrt((p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y))"
    starts = f"SELECT min_by(n.c, {far}) AS cs, min({far}) AS own FROM ({facilities_utm_sql()}) p, n GROUP BY p.id"
    dist = f"SELECT n.j, n.x, n.y, min(abs(n.c - s.cs) + s.own) AS dist FROM n, ({starts}) s GROUP BY n.j, n.x, n.y"
    pts = f"SELECT hex_id, cx AS x, cy AS y FROM ({exposure_grid_sql()}) e WHERE population > 0"
    km = f"SELECT p.hex_id, (min_by(n.dist, {far}) + min({far})) / 1000e0 AS km FROM ({pts}) p, ({dist}) n GROUP BY p.hex_id"
    return (f"WITH n AS ({_far_road_nodes()}) SELECT hex_id, round(km, 3) AS nearest_facility_km, {access_class_expr('km')} AS accessibility_class "
            f"FROM ({km}) k")


@oracle("exposure_stream")
def _exposure_stream():
    return (f"SELECT hex_id, round(population, 6) AS population, round(population_exposed, 6) AS population_exposed "
            f"FROM ({per_hex_sql()}) p")


# ============================================================================ the manifest, over other oracles

@oracle("output_manifest")
def _output_manifest():
    v = f"SELECT lon AS x, lat AS y FROM ({_grid_lonlat_vertices()}) v"
    a = f"SELECT v.x AS x, v.y AS y FROM (SELECT unnest(ring) AS v FROM ({admin_rings_sql()}) r) u"
    f = f"SELECT lon AS x, lat AS y FROM ({lonlat_sql(facilities_utm_sql(), 'x', 'y', 'id')}) f"
    none = "SELECT CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y"
    pq, gj = "application/vnd.apache.parquet", "application/geo+json-seq"
    parts = [
        ("grid", f"SELECT count(*) FROM ({grid_sql()}) g", v, pq),
        ("admin", "SELECT count(*) FROM nation", a, pq),
        ("facilities", "SELECT count(*) FROM supplier", f, pq),
        ("run_summary", "SELECT 1", none, pq),
        ("class_counts", f"SELECT count(*) FROM ({ORACLES['class_counts']}) c", none, pq),
        ("admin_rollup", f"SELECT count(*) FROM ({ORACLES['admin_rollup']}) c", none, pq),
        ("hexagon_tiles", f"SELECT count(*) FROM ({_tiles_sql()}) t", none, pq),
        ("facility_tiles", "SELECT count(*) * 9 FROM supplier", none, pq),
        ("exposed_population", f"SELECT count(*) FROM ({pop_cells_sql()}) c", none, pq),
        ("hexagons_geojson", f"SELECT count(*) FROM ({exposure_grid_sql()}) e WHERE population > 0", none, gj),
    ]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS asset, ({count}) AS n_rows, round(min(x), 7) AS xmin, round(min(y), 7) AS ymin, round(max(x), 7) AS xmax, "
        f"round(max(y), 7) AS ymax, '{media}' AS media_type, '2024-01-17T00:00:00' AS created, '{n}' AS folder, "
        f"'EPSG:32735' AS study_crs FROM ({q}) _{n}" for n, count, q, media in parts)
