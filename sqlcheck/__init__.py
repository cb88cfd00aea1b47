"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes a query from the raw tables with plain SQL
arithmetic (no spatial extension): derived inputs, projection series,
hexagon assignment, ray casting and brute-force nearest search.  The
formulas are written out here as SQL text, independently of the Spark
Column code, and use the same operation order so both engines produce
identical doubles wherever the maths is basic arithmetic.
"""

from __future__ import annotations

import math

# Fixed values shared with the Spark side (study box and derivation rules).
W, S, E, N = 27.3, -4.5, 29.1, -3.5
KEY_MULT_X = 0.6180339887498949
KEY_MULT_Y = 0.7548776662466927
RES = 6
ZONE = 35
THRESHOLD_KM, MODERATE_KM = 5.0, 10.0
EXPOSURE_W, ACCESS_W = 0.6, 0.4
TOP_PCT = 10.0

# WGS84 / UTM (public standards) and series terms, to third order in n.
_A = 6378137.0
_F = 1.0 / 298.257223563
_n = _F / (2.0 - _F)
_RA = _A / (1.0 + _n) * (1.0 + _n ** 2 / 4.0 + _n ** 4 / 64.0)
_e = 2.0 * math.sqrt(_n) / (1.0 + _n)
_K0A = 0.9996 * _RA
_ALPHA = (_n / 2.0 - 2.0 * _n ** 2 / 3.0 + 5.0 * _n ** 3 / 16.0,
          13.0 * _n ** 2 / 48.0 - 3.0 * _n ** 3 / 5.0, 61.0 * _n ** 3 / 240.0)
_BETA = (_n / 2.0 - 2.0 * _n ** 2 / 3.0 + 37.0 * _n ** 3 / 96.0,
         _n ** 2 / 48.0 + _n ** 3 / 15.0, 17.0 * _n ** 3 / 480.0)
_DELTA = (2.0 * _n - 2.0 * _n ** 2 / 3.0 - 2.0 * _n ** 3,
          7.0 * _n ** 2 / 3.0 - 8.0 * _n ** 3 / 5.0, 56.0 * _n ** 3 / 15.0)
_LAM0 = math.radians(-183.0 + 6.0 * ZONE)


def d(v: float) -> str:
    """A DOUBLE literal that round-trips exactly (never DECIMAL)."""
    return format(float(v), ".17e")


def hex_edge(res: int) -> float:
    area_m2 = 4357449.416078383 / (7.0 ** res) * 1.0e6
    return math.sqrt(2.0 * area_m2 / (3.0 * math.sqrt(3.0)))


def frac(x: str) -> str:
    return f"(({x}) - floor({x}))"


def key_lon(k: str) -> str:
    return f"({d(W)} + {frac(f'CAST({k} AS DOUBLE) * {d(KEY_MULT_X)}')} * {d(E - W)})"


def key_lat(k: str) -> str:
    return f"({d(S)} + {frac(f'CAST({k} AS DOUBLE) * {d(KEY_MULT_Y)}')} * {d(N - S)})"


# --------------------------------------------------------------------------- projection

def utm_sql(src: str, lon: str, lat: str, cols: str, x: str = "x", y: str = "y") -> str:
    """Wrap query ``src`` adding UTM columns ``x``/``y`` from ``lon``/``lat``;
    ``cols`` are the passthrough columns (comma list, may be empty)."""
    c = f"{cols}, " if cols else ""
    e = d(_e)
    l1 = (f"SELECT {c}radians({lat}) AS _phi, radians({lon}) - {d(_LAM0)} AS _dl FROM ({src}) _s0")
    l2 = (f"SELECT {c}sinh(atanh(sin(_phi)) - {e} * atanh({e} * sin(_phi))) AS _t, _dl FROM ({l1}) _s1")
    l3 = (f"SELECT {c}atan2(_t, cos(_dl)) AS _xi, atanh(sin(_dl) / sqrt({d(1.0)} + _t * _t)) AS _eta "
          f"FROM ({l2}) _s2")
    es, ns = "_eta", "_xi"
    for j, a in enumerate(_ALPHA, start=1):
        es = f"({es} + {d(a)} * cos({d(2.0 * j)} * _xi) * sinh({d(2.0 * j)} * _eta))"
        ns = f"({ns} + {d(a)} * sin({d(2.0 * j)} * _xi) * cosh({d(2.0 * j)} * _eta))"
    return (f"SELECT {c}{d(500000.0)} + {d(_K0A)} * {es} AS {x}, "
            f"{d(_K0A)} * {ns} + {d(10000000.0)} AS {y} FROM ({l3}) _s3")


def lonlat_sql(src: str, x: str, y: str, cols: str, lon: str = "lon", lat: str = "lat") -> str:
    """Wrap query ``src`` adding lon/lat columns from UTM ``x``/``y``."""
    c = f"{cols}, " if cols else ""
    l1 = (f"SELECT {c}({y} - {d(10000000.0)}) / {d(_K0A)} AS _xi, ({x} - {d(500000.0)}) / {d(_K0A)} AS _eta "
          f"FROM ({src}) _i0")
    xp, ep = "_xi", "_eta"
    for j, b in enumerate(_BETA, start=1):
        xp = f"({xp} - {d(b)} * sin({d(2.0 * j)} * _xi) * cosh({d(2.0 * j)} * _eta))"
        ep = f"({ep} - {d(b)} * cos({d(2.0 * j)} * _xi) * sinh({d(2.0 * j)} * _eta))"
    l2 = f"SELECT {c}{xp} AS _xp, {ep} AS _ep FROM ({l1}) _i1"
    l3 = f"SELECT {c}asin(sin(_xp) / cosh(_ep)) AS _chi, _xp, _ep FROM ({l2}) _i2"
    ph = "_chi"
    for j, dd in enumerate(_DELTA, start=1):
        ph = f"({ph} + {d(dd)} * sin({d(2.0 * j)} * _chi))"
    return (f"SELECT {c}degrees({d(_LAM0)} + atan2(sinh(_ep), cos(_xp))) AS {lon}, degrees({ph}) AS {lat} "
            f"FROM ({l3}) _i3")


# --------------------------------------------------------------------------- hexagons

def hex_assign_sql(src: str, x: str, y: str, cols: str, res: int = RES, out: str = "hex_id",
                   keep_qr: bool = False) -> str:
    s = hex_edge(res)
    c = f"{cols}, " if cols else ""
    l1 = (f"SELECT {c}({d(math.sqrt(3.0) / 3.0)} * {x} - {y} / {d(3.0)}) / {d(s)} AS _fq, "
          f"({d(2.0 / 3.0)} * {y}) / {d(s)} AS _fr FROM ({src}) _h0")
    l2 = (f"SELECT {c}_fq, _fr, -_fq - _fr AS _fs, floor(_fq + {d(0.5)}) AS _rq, floor(_fr + {d(0.5)}) AS _rr, "
          f"floor(-_fq - _fr + {d(0.5)}) AS _rs FROM ({l1}) _h1")
    l3 = (f"SELECT {c}_rq, _rr, _rs, abs(_rq - _fq) AS _dq, abs(_rr - _fr) AS _dr, abs(_rs - _fs) AS _ds "
          f"FROM ({l2}) _h2")
    l4 = (f"SELECT {c}CAST(CASE WHEN _dq > _dr AND _dq > _ds THEN -_rr - _rs ELSE _rq END AS BIGINT) AS _q, "
          f"CAST(CASE WHEN NOT (_dq > _dr AND _dq > _ds) AND _dr > _ds THEN -_rq - _rs ELSE _rr END AS BIGINT) AS _r "
          f"FROM ({l3}) _h3")
    qr = ", _q AS q, _r AS r" if keep_qr else ""
    return f"SELECT {c}'{res}_' || CAST(_q AS VARCHAR) || '_' || CAST(_r AS VARCHAR) AS {out}{qr} FROM ({l4}) _h4"


def hex_center_exprs(q: str, r: str, res: int = RES) -> tuple[str, str]:
    s = hex_edge(res)
    return (f"({d(s * math.sqrt(3.0))} * (CAST({q} AS DOUBLE) + CAST({r} AS DOUBLE) / {d(2.0)}))",
            f"({d(1.5 * s)} * CAST({r} AS DOUBLE))")


# --------------------------------------------------------------------------- derived inputs

def admin_rings_sql(tiles: int = 5) -> str:
    dx, dy = (E - W) / tiles, (N - S) / tiles
    cc = f"CAST(n_nationkey % {tiles} AS DOUBLE)"
    rr = f"CAST(n_nationkey // {tiles} AS DOUBLE)"
    w_ = f"({d(W)} + {cc} * {d(dx)})"
    e_ = f"({d(W)} + ({cc} + {d(1.0)}) * {d(dx)})"
    n_ = f"({d(N)} - {rr} * {d(dy)})"
    s_ = f"({d(N)} - ({rr} + {d(1.0)}) * {d(dy)})"
    ring = (f"[{{'x': {w_}, 'y': {s_}}}, {{'x': {e_}, 'y': {s_}}}, {{'x': {e_}, 'y': {n_}}}, "
            f"{{'x': {w_}, 'y': {n_}}}, {{'x': {w_}, 'y': {s_}}}]")
    return (f"SELECT CAST(n_nationkey AS BIGINT) AS admin_id, 'COD' AS GID_0, r_name AS NAME_0, "
            f"'COD.' || CAST(n_nationkey AS VARCHAR) AS GID_3, n_name AS NAME_3, {ring} AS ring "
            f"FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")


#: Corners as shares of a unit's box: parts, rings, corners (the same figures as the Spark side's).
SHAPES = {
    0: [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]],
    1: [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(0.35, 0.35), (0.35, 0.65), (0.65, 0.65), (0.65, 0.35)]]],
    2: [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.6, 1.0), (0.5, 0.4), (0.4, 1.0), (0.0, 1.0)]]],
    3: [[[(0.0, 0.0), (0.45, 0.0), (0.45, 1.0), (0.0, 1.0)]], [[(0.55, 0.0), (1.0, 0.0), (1.0, 1.0), (0.55, 1.0)]]],
}


def admin_shape_rings_sql(tiles: int = 5) -> str:
    """(admin_id, part_id, pid, ring_no, ring): one row per ring; pid tells parts apart."""
    dx, dy = (E - W) / tiles, (N - S) / tiles
    rows = []
    for kind, parts in SHAPES.items():
        for part, rings in enumerate(parts):
            for no, corners in enumerate(rings):
                pts = ", ".join(f"{{'x': ring[1].x + {d(fx)} * {d(dx)}, 'y': ring[1].y + {d(fy)} * {d(dy)}}}" for fx, fy in (*corners, corners[0]))
                rows.append(f"SELECT admin_id, {part} AS part_id, admin_id * 10 + {part} AS pid, {no} AS ring_no, [{pts}] AS ring "
                            f"FROM ({admin_rings_sql(tiles)}) _a WHERE admin_id % 4 = {kind}")
    return " UNION ALL ".join(rows)


def ray_cast_sql(points: str, rings: str, pid: str, px: str, py: str, rid: str, ring: str = "ring") -> str:
    """(pid, rid) pairs where the point is inside the ring (even-odd rule).
    ``points`` and ``rings`` are relations already joined as candidates in
    ``points`` (it must carry ``rid``); ``rings`` provides the ring per rid."""
    return f"""
SELECT {pid}, {rid} FROM (
  SELECT p.{pid}, p.{rid}, p.{px} AS _px, p.{py} AS _py, e.a, e.b
  FROM ({points}) p JOIN (
    SELECT {rid}, {ring}[i] AS a, {ring}[i + 1] AS b
    FROM (SELECT {rid}, {ring}, unnest(range(1, len({ring}))) AS i FROM ({rings}) _rr) _ri
  ) e USING ({rid})
) _pe
GROUP BY {pid}, {rid}
HAVING sum(CASE WHEN ((a.y > _py) <> (b.y > _py))
                 AND _px < (b.x - a.x) * (_py - a.y) / (b.y - a.y) + a.x THEN 1 ELSE 0 END) % 2 = 1
"""


def inside_sql(admin: str, res: int = RES) -> str:
    """(hex_id, admin_id): hexagons whose centre (in lon/lat) is inside the rings (admin_id, ring; one row per ring) of a unit."""
    s = hex_edge(res)
    verts = f"SELECT admin_id, v.x AS lon, v.y AS lat FROM (SELECT admin_id, unnest(ring) AS v FROM ({admin}) _a) _v"
    vu = utm_sql(verts, "lon", "lat", "admin_id")
    bb = (f"SELECT admin_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax "
          f"FROM ({vu}) _vu GROUP BY admin_id")
    rows = (f"SELECT admin_id, xmin, xmax, unnest(range(CAST(floor(ymin / {d(1.5 * s)}) AS BIGINT) - 1, "
            f"CAST(ceil(ymax / {d(1.5 * s)}) AS BIGINT) + 2)) AS r FROM ({bb}) _bb")
    k = d(s * math.sqrt(3.0))
    cand = (f"SELECT admin_id, r, unnest(range(CAST(floor(xmin / {k} - CAST(r AS DOUBLE) / {d(2.0)}) AS BIGINT) - 1, "
            f"CAST(ceil(xmax / {k} - CAST(r AS DOUBLE) / {d(2.0)}) AS BIGINT) + 2)) AS q FROM ({rows}) _rw")
    cx, cy = hex_center_exprs("q", "r", res)
    cxy = f"SELECT admin_id, q, r, {cx} AS cx, {cy} AS cy FROM ({cand}) _c"
    ll = lonlat_sql(cxy, "cx", "cy", "admin_id, q, r")
    pts = f"SELECT admin_id, q, r, '{res}_' || CAST(q AS VARCHAR) || '_' || CAST(r AS VARCHAR) AS hex_id, lon, lat FROM ({ll}) _ll"
    return ray_cast_sql(pts, admin, "hex_id", "lon", "lat", "admin_id")


def grid_sql(res: int = RES) -> str:
    """hex_id, q, r of the hexagons whose centre (in lon/lat) is inside any admin ring."""
    inside = inside_sql(admin_rings_sql(), res)
    return (f"SELECT DISTINCT hex_id, CAST(split_part(hex_id, '_', 2) AS BIGINT) AS q, "
            f"CAST(split_part(hex_id, '_', 3) AS BIGINT) AS r FROM ({inside}) _in")


def square_meta_sql(table: str) -> str:
    return (f"SELECT w, CAST(ceil(n / w) AS BIGINT) AS h, {d(E - W)} / w AS dx, {d(N - S)} / CAST(ceil(n / w) AS BIGINT) AS dy "
            f"FROM (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS w FROM (SELECT count(*) AS n FROM {table}) _n) _w")


def pop_cells_sql() -> str:
    return (f"SELECT o_orderkey // w AS row, o_orderkey % w AS col, "
            f"greatest(o_totalprice / {d(10000.0)}, {d(0.0)}) AS value "
            f"FROM orders, ({square_meta_sql('orders')}) m")


def flood_cells_sql() -> str:
    k = "CAST(c_custkey AS DOUBLE)"
    depth = (f"CASE WHEN {frac(f'{k} * {d(KEY_MULT_X)}')} <= {d(0.7)} THEN {d(0.0)} "
             f"ELSE {d(0.5)} + {d(2.5)} * {frac(f'{k} * {d(KEY_MULT_Y)}')} END")
    return f"SELECT c_custkey // w AS row, c_custkey % w AS col, {depth} AS value FROM customer, ({square_meta_sql('customer')}) m"


def pop_xy_sql() -> str:
    """Valid population cells with centre lon/lat."""
    return (f"SELECT row, col, value, {d(W)} + (CAST(col AS DOUBLE) + {d(0.5)}) * m.dx AS lon, "
            f"{d(N)} - (CAST(row AS DOUBLE) + {d(0.5)}) * m.dy AS lat "
            f"FROM ({pop_cells_sql()}) c, ({square_meta_sql('orders')}) m WHERE value IS NOT NULL AND NOT isnan(value)")


def aligned_sql() -> str:
    """Population cells with the flood depth of the flood cell holding their centre (0 if none/dry)."""
    fm = square_meta_sql("customer")
    pc = (f"SELECT p.*, CAST(floor(({d(N)} - p.lat) / fm.dy) AS BIGINT) AS frow, "
          f"CAST(floor((p.lon - {d(W)}) / fm.dx) AS BIGINT) AS fcol FROM ({pop_xy_sql()}) p, ({fm}) fm")
    wet = f"SELECT row AS frow, col AS fcol, value AS depth FROM ({flood_cells_sql()}) f WHERE value <> {d(0.0)} AND NOT isnan(value) AND value > {d(0.0)}"
    return (f"SELECT pc.row, pc.col, pc.value, pc.lon, pc.lat, coalesce(wet.depth, {d(0.0)}) AS depth "
            f"FROM ({pc}) pc LEFT JOIN ({wet}) wet ON pc.frow = wet.frow AND pc.fcol = wet.fcol")


def exposure_cells_sql(res: int = RES) -> str:
    u = utm_sql(aligned_sql(), "lon", "lat", "row, col, value, depth")
    return hex_assign_sql(u, "x", "y", "row, col, value, depth", res)


def per_hex_sql(res: int = RES) -> str:
    return (f"SELECT hex_id, sum(value) AS population, "
            f"sum(CASE WHEN depth > 0 THEN value ELSE {d(0.0)} END) AS population_exposed "
            f"FROM ({exposure_cells_sql(res)}) ec GROUP BY hex_id")


def exposure_grid_sql(res: int = RES) -> str:
    """Grid hexes with centroid (UTM), population, exposed and percent."""
    cx, cy = hex_center_exprs("g.q", "g.r", res)
    return (f"SELECT g.hex_id, {cx} AS cx, {cy} AS cy, coalesce(ph.population, {d(0.0)}) AS population, "
            f"coalesce(ph.population_exposed, {d(0.0)}) AS population_exposed FROM ({grid_sql(res)}) g "
            f"LEFT JOIN ({per_hex_sql(res)}) ph USING (hex_id)")


def pct_expr(exp: str, pop: str) -> str:
    return f"coalesce({exp} / CASE WHEN {pop} = 0 THEN {d(1.0)} ELSE {pop} END * {d(100.0)}, {d(0.0)})"


def facilities_utm_sql() -> str:
    src = (f"SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, "
           f"CASE WHEN s_suppkey % 2 = 0 THEN 'clinic' ELSE 'hospital' END AS amenity, "
           f"{key_lon('s_suppkey')} AS lon, {key_lat('s_suppkey')} AS lat FROM supplier")
    return utm_sql(src, "lon", "lat", "id, name, amenity")


def nearest_sql(points: str, pid: str = "hex_id", px: str = "cx", py: str = "cy") -> str:
    """Brute force: every point against every facility, best by (d2, id)."""
    return f"""
SELECT {pid}, id AS facility_id, sqrt(d2) AS distance_m FROM (
  SELECT p.{pid}, f.id, (p.{px} - f.x) * (p.{px} - f.x) + (p.{py} - f.y) * (p.{py} - f.y) AS d2,
         row_number() OVER (PARTITION BY p.{pid} ORDER BY (p.{px} - f.x) * (p.{px} - f.x) + (p.{py} - f.y) * (p.{py} - f.y), f.id) AS rn
  FROM ({points}) p CROSS JOIN ({facilities_utm_sql()}) f
) _nn WHERE rn = 1
"""


def access_class_expr(dk: str) -> str:
    return (f"CASE WHEN {dk} IS NULL THEN NULL WHEN {dk} < {d(THRESHOLD_KM)} THEN 'good' "
            f"WHEN {dk} < {d(MODERATE_KM)} THEN 'moderate' ELSE 'poor' END")


def access_score_expr(dk: str) -> str:
    t, m = d(THRESHOLD_KM), d(MODERATE_KM)
    return (f"CASE WHEN {dk} IS NULL THEN NULL WHEN {dk} < {t} THEN {d(1.0)} - ({dk} / {t}) * {d(0.5)} "
            f"WHEN {dk} < {m} THEN {d(0.5)} - (({dk} - {t}) / ({m} - {t})) * {d(0.3)} "
            f"ELSE greatest({d(0.2)} - ({dk} - {m}) * {d(0.01)}, {d(0.0)}) END")


def access_grid_sql(res: int = RES) -> str:
    eg = exposure_grid_sql(res)
    nn = nearest_sql(f"SELECT hex_id, cx, cy FROM ({eg}) _e WHERE population > 0")
    dk = "(nn.distance_m / 1000e0)"
    return (f"SELECT eg.*, {dk} AS nearest_facility_km, {access_class_expr(dk)} AS accessibility_class, "
            f"{access_score_expr(dk)} AS accessibility_score FROM ({eg}) eg LEFT JOIN ({nn}) nn USING (hex_id)")


def priority_grid_sql(res: int = RES) -> str:
    ag = access_grid_sql(res)
    mm = "SELECT min(population_exposed) AS lo, max(population_exposed) AS hi FROM ag WHERE population > 0"
    es = (f"CASE WHEN ag.population > 0 THEN (CASE WHEN mm.hi > mm.lo THEN (ag.population_exposed - mm.lo) / (mm.hi - mm.lo) "
          f"ELSE {d(0.0)} END) END")
    sc = (f"SELECT ag.*, {es} AS exposure_score FROM ag, ({mm}) mm")
    ps = (f"SELECT *, CASE WHEN population > 0 THEN exposure_score * {d(EXPOSURE_W)} + "
          f"({d(1.0)} - coalesce(accessibility_score, {d(0.0)})) * {d(ACCESS_W)} END AS priority_score FROM ({sc}) _sc")
    q = (100.0 - TOP_PCT) / 100.0
    th = (f"SELECT quantile_cont(priority_score, {d(q)}) AS p_hi, quantile_cont(priority_score, {d(0.5)}) AS p_mid "
          f"FROM ps WHERE population > 0")
    cls = (f"CASE WHEN ps.population > 0 THEN (CASE WHEN ps.priority_score >= th.p_hi THEN 'high' "
           f"WHEN ps.priority_score >= th.p_mid THEN 'medium' ELSE 'low' END) END")
    return (f"WITH ag AS ({ag}), ps AS ({ps}) SELECT ps.*, {cls} AS priority_class FROM ps, ({th}) th")


# --------------------------------------------------------------------------- more derived inputs

FIXTURE_BOX = (27.5, -4.0, 28.0, -3.5)


def facilities_lonlat_sql() -> str:
    return (f"SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, "
            f"CASE WHEN s_suppkey % 2 = 0 THEN 'clinic' ELSE 'hospital' END AS amenity, "
            f"{key_lon('s_suppkey')} AS lon, {key_lat('s_suppkey')} AS lat FROM supplier")


def places_sql(half: float = 1e-4) -> str:
    lon, lat = key_lon("p_partkey"), key_lat("p_partkey")
    return (f"SELECT 'place_' || CAST(p_partkey AS VARCHAR) AS id, lower(p_type) AS theme, {lon} AS lon, {lat} AS lat, "
            f"{lon} - {d(half)} AS xmin, {lon} + {d(half)} AS xmax, {lat} - {d(half)} AS ymin, "
            f"{lat} + {d(half)} AS ymax FROM part")


def contained(w: float, s: float, e: float, n: float) -> str:
    return f"xmin >= {d(w)} AND xmax <= {d(e)} AND ymin >= {d(s)} AND ymax <= {d(n)}"


def pop_points_sql() -> str:
    return (f"SELECT CAST(c_custkey AS BIGINT) AS pid, {key_lon('c_custkey')} AS lon, {key_lat('c_custkey')} AS lat, "
            f"greatest(c_acctbal, {d(0.0)}) AS weight FROM customer")


def grid_vertices_sql(src: str, res: int = RES) -> str:
    """7 boundary vertices (i = 0..6, closed) of the hexagons (q, r) in ``src``."""
    s = hex_edge(res)
    cx, cy = hex_center_exprs("q", "r", res)
    ang = f"radians({d(30.0)} + {d(60.0)} * CAST(i % 6 AS DOUBLE))"
    return (f"SELECT hex_id, i, {cx} + {d(s)} * cos({ang}) AS x, {cy} + {d(s)} * sin({ang}) AS y "
            f"FROM (SELECT *, unnest(range(0, 7)) AS i FROM ({src}) _g) _gv")


def ring_vertices_sql(src: str, rid: str, ring: str = "ring") -> str:
    """(rid, i 1-based, x, y, nx, ny): each vertex with the next one (closed rings)."""
    return (f"SELECT {rid}, i, {ring}[i].x AS x, {ring}[i].y AS y, {ring}[i + 1].x AS nx, {ring}[i + 1].y AS ny "
            f"FROM (SELECT {rid}, {ring}, unnest(range(1, len({ring}))) AS i FROM ({src}) _s) _rv")


def shoelace_sql(src: str, rid: str, ring: str = "ring") -> str:
    """(rid, cross_sum): twice the signed area of each ring."""
    return (f"SELECT {rid}, sum(x * ny - nx * y) AS cross_sum FROM ({ring_vertices_sql(src, rid, ring)}) _v GROUP BY {rid}")


def self_cross_sql(src: str, rid: str, ring: str = "ring") -> str:
    """rids whose ring has two non-adjacent edges properly crossing."""
    e = ring_vertices_sql(src, rid, ring)
    o = "((qx - px) * (ry - py) - (qy - py) * (rx - px))"

    def orient(p, q, rr):
        return o.replace("px", f"{p}x").replace("py", f"{p}y").replace("qx", f"{q}x").replace(
            "qy", f"{q}y").replace("rx", f"{rr}x").replace("ry", f"{rr}y")
    return f"""
SELECT DISTINCT a.{rid} FROM ({e}) a JOIN ({e}) b ON a.{rid} = b.{rid} AND b.i >= a.i + 2
JOIN (SELECT {rid}, len({ring}) - 1 AS n_edges FROM ({src}) _n) n ON n.{rid} = a.{rid}
WHERE NOT (a.i = 1 AND b.i = n.n_edges)
  AND {orient('a.', 'a.n', 'b.')} * {orient('a.', 'a.n', 'b.n')} < 0
  AND {orient('b.', 'b.n', 'a.')} * {orient('b.', 'b.n', 'a.n')} < 0
"""


def tile_sql(lon: str, lat: str, z: str) -> tuple[str, str]:
    n = f"pow({d(2.0)}, CAST({z} AS DOUBLE))"
    x = f"least(greatest(CAST(floor(({lon} + {d(180.0)}) / {d(360.0)} * {n}) AS BIGINT), 0), CAST({n} AS BIGINT) - 1)"
    lr = f"radians({lat})"
    y = (f"least(greatest(CAST(floor(({d(1.0)} - ln(tan({lr}) + {d(1.0)} / cos({lr})) / {d(math.pi)}) / {d(2.0)} * {n}) "
         f"AS BIGINT), 0), CAST({n} AS BIGINT) - 1)")
    return x, y
