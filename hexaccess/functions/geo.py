"""Projection and planar geometry as Spark Column expressions.

Points are ``struct<x double, y double>``; rings are ``array<point>``
(closed: last = first); polygons are ``array<ring>`` (outer first).
Everything here returns a Column so it stays inside Catalyst and
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and the UTM definition (public standards).
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0

_N = WGS84_F / (2.0 - WGS84_F)
_RECT_A = WGS84_A / (1.0 + _N) * (1.0 + _N ** 2 / 4.0 + _N ** 4 / 64.0)
_E = 2.0 * math.sqrt(_N) / (1.0 + _N)
# Krueger series coefficients to third order in n.
_ALPHA = (
    _N / 2.0 - 2.0 * _N ** 2 / 3.0 + 5.0 * _N ** 3 / 16.0,
    13.0 * _N ** 2 / 48.0 - 3.0 * _N ** 3 / 5.0,
    61.0 * _N ** 3 / 240.0,
)
_BETA = (
    _N / 2.0 - 2.0 * _N ** 2 / 3.0 + 37.0 * _N ** 3 / 96.0,
    _N ** 2 / 48.0 + _N ** 3 / 15.0,
    17.0 * _N ** 3 / 480.0,
)
_DELTA = (
    2.0 * _N - 2.0 * _N ** 2 / 3.0 - 2.0 * _N ** 3,
    7.0 * _N ** 2 / 3.0 - 8.0 * _N ** 3 / 5.0,
    56.0 * _N ** 3 / 15.0,
)


def _c(v) -> Column:
    return v if isinstance(v, Column) else (F.col(v) if isinstance(v, str) else F.lit(v))


def point(x, y) -> Column:
    """Build a ``struct<x,y>`` point column."""
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def central_meridian(zone: int) -> float:
    return -183.0 + 6.0 * zone


def utm_coefficients() -> dict:
    """Series constants, exposed for the SQL oracle and tests."""
    return {"A": _RECT_A, "e": _E, "alpha": _ALPHA, "beta": _BETA, "delta": _DELTA}


def to_utm(lon, lat, zone: int = 35, south: bool = True) -> Column:
    """lon/lat degrees -> UTM metres as ``struct<x,y>`` (Krueger series)."""
    lam0 = math.radians(central_meridian(zone))
    phi = F.radians(_c(lat).cast("double"))
    dlam = F.radians(_c(lon).cast("double")) - F.lit(lam0)
    sphi = F.sin(phi)
    t = F.sinh(F.atanh(sphi) - F.lit(_E) * F.atanh(F.lit(_E) * sphi))
    xi = F.atan2(t, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    e_sum = eta
    n_sum = xi
    for j, a in enumerate(_ALPHA, start=1):
        e_sum = e_sum + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        n_sum = n_sum + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    k0a = UTM_K0 * _RECT_A
    x = F.lit(UTM_FALSE_EASTING) + F.lit(k0a) * e_sum
    y = F.lit(k0a) * n_sum + F.lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)
    return F.struct(x.alias("x"), y.alias("y"))


def to_lonlat(x, y, zone: int = 35, south: bool = True) -> Column:
    """UTM metres -> lon/lat degrees as ``struct<x,y>`` (inverse series)."""
    k0a = UTM_K0 * _RECT_A
    xi = (_c(y).cast("double") - F.lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)) / F.lit(k0a)
    eta = (_c(x).cast("double") - F.lit(UTM_FALSE_EASTING)) / F.lit(k0a)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(_BETA, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        eta_p = eta_p - F.lit(b) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lam = F.lit(math.radians(central_meridian(zone))) + F.atan2(F.sinh(eta_p), F.cos(xi_p))
    return F.struct(F.degrees(lam).alias("x"), F.degrees(phi).alias("y"))


def ring_to_utm(ring, zone: int = 35, south: bool = True) -> Column:
    """Project every vertex of a lon/lat ring to UTM: the terms of ``to_utm``, one pass over the vertices per
    stage.  Spark evaluates a lambda as written, so a term used twice within one is computed twice."""
    lam0, e = math.radians(central_meridian(zone)), F.lit(_E)
    v = F.transform(_c(ring), lambda p: F.struct(
        F.sin(F.radians(p["y"].cast("double"))).alias("s"), (F.radians(p["x"].cast("double")) - F.lit(lam0)).alias("dl")))
    v = F.transform(v, lambda p: F.struct(F.sinh(F.atanh(p["s"]) - e * F.atanh(e * p["s"])).alias("t"), p["dl"].alias("dl")))
    v = F.transform(v, lambda p: F.struct(
        F.atan2(p["t"], F.cos(p["dl"])).alias("xi"), F.atanh(F.sin(p["dl"]) / F.sqrt(F.lit(1.0) + p["t"] * p["t"])).alias("eta")))

    def summed(p):
        xi, eta = p["xi"], p["eta"]
        e_sum, n_sum = eta, xi
        for j, a in enumerate(_ALPHA, start=1):
            e_sum = e_sum + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
            n_sum = n_sum + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        k0a = UTM_K0 * _RECT_A
        return F.struct((F.lit(UTM_FALSE_EASTING) + F.lit(k0a) * e_sum).alias("x"),
                        (F.lit(k0a) * n_sum + F.lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)).alias("y"))

    return F.transform(v, summed)


def ring_to_lonlat(ring, zone: int = 35, south: bool = True) -> Column:
    return F.transform(_c(ring), lambda p: to_lonlat(p["x"], p["y"], zone, south))


def distance(ax, ay, bx, by) -> Column:
    """Planar distance, in the unit of the inputs."""
    dx = _c(ax) - _c(bx)
    dy = _c(ay) - _c(by)
    return F.sqrt(dx * dx + dy * dy)


def distance_km(ax, ay, bx, by) -> Column:
    return distance(ax, ay, bx, by) / F.lit(1000.0)


def point_segment_distance(px, py, ax, ay, bx, by) -> Column:
    """Distance from a point to the segment a-b (projection clamped to [0,1])."""
    px, py, ax, ay, bx, by = map(_c, (px, py, ax, ay, bx, by))
    vx, vy = bx - ax, by - ay
    len2 = vx * vx + vy * vy
    t = F.when(len2 > 0, ((px - ax) * vx + (py - ay) * vy) / F.when(len2 > 0, len2)).otherwise(0.0)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return distance(px, py, ax + t * vx, ay + t * vy)


def point_line_distance(px, py, line) -> Column:
    """Minimum distance from a point to a linestring (array of points)."""
    line = _c(line)
    segs = F.sequence(F.lit(0), F.size(line) - 2)
    dists = F.transform(
        segs,
        lambda i: point_segment_distance(px, py, F.get(line, i)["x"], F.get(line, i)["y"],
                                         F.get(line, i + 1)["x"], F.get(line, i + 1)["y"]),
    )
    return F.array_min(dists)


def line_length(line) -> Column:
    """Length of a linestring in the unit of its coordinates."""
    line = _c(line)
    steps = F.transform(F.sequence(F.lit(0), F.size(line) - 2), lambda i: distance(
        F.get(line, i)["x"], F.get(line, i)["y"], F.get(line, i + 1)["x"], F.get(line, i + 1)["y"]))
    return F.when(F.size(line) >= 2, F.aggregate(steps, F.lit(0.0), lambda t, d: t + d)).otherwise(0.0)


def box_ring(west, south, east, north) -> Column:
    """Closed counter-clockwise ring of a box: SW, SE, NE, NW, SW."""
    w, s, e, n = map(_c, (west, south, east, north))
    return F.array(point(w, s), point(e, s), point(e, n), point(w, n), point(w, s))


def parse_epsg(crs) -> Column:
    """'EPSG:32735' -> 32735."""
    return F.element_at(F.split(_c(crs), ":"), 2).cast("int")


def _fmt(v: Column, digits: int | None) -> Column:
    """A number as text: every digit it has, or rounded on request."""
    return v.cast("string") if digits is None else F.format_string(f"%.{digits}f", v)


def _with_srid(wkt: Column, srid) -> Column:
    return wkt if srid is None else F.concat(F.lit("SRID="), _c(srid).cast("string"), F.lit(";"), wkt)


def rings_to_wkt(rings, srid=None, digits: int | None = None) -> Column:
    """Polygon WKT (``SRID=...;POLYGON((x y, ...), (hole))``) from all rings of a polygon."""
    texts = F.transform(_c(rings), lambda ring: F.concat(F.lit("("), F.array_join(
        F.transform(ring, lambda p: F.concat_ws(" ", _fmt(p["x"], digits), _fmt(p["y"], digits))), ", "), F.lit(")")))
    return _with_srid(F.concat(F.lit("POLYGON("), F.array_join(texts, ", "), F.lit(")")), srid)


def ring_to_wkt(ring, srid=None, digits: int | None = None) -> Column:
    """Polygon WKT of a single ring."""
    return rings_to_wkt(F.array(_c(ring)), srid, digits)


def point_to_wkt(x, y, srid=None, digits: int | None = None) -> Column:
    return _with_srid(F.concat(F.lit("POINT("), _fmt(_c(x), digits), F.lit(" "), _fmt(_c(y), digits), F.lit(")")), srid)


def wkt_srid(wkt) -> Column:
    """SRID of an EWKT string, NULL when absent."""
    s = F.regexp_extract(_c(wkt), r"^SRID=(\d+);", 1)
    return F.when(s == "", F.lit(None)).otherwise(s).cast("int")


def _coordinates(text: Column) -> Column:
    """``x y, x y, ...`` -> array of points."""
    words = F.transform(F.split(F.trim(text), r"\s*,\s*"), lambda p: F.split(F.trim(p), r"\s+"))   # each split once
    return F.transform(words, lambda w: point(F.get(w, 0).cast("double"), F.get(w, 1).cast("double")))


def wkt_to_parts(wkt) -> Column:
    """All parts of a (MULTI)POLYGON (E)WKT, each the array of its rings; a
    LINESTRING or POINT is one part of one ring.  EMPTY gives no part."""
    body = F.regexp_replace(_c(wkt), r"^[^(]*", "")
    parts = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")
    rings = F.transform(parts, lambda part: F.transform(
        F.split(part, r"\)\s*,\s*\("), lambda ring: _coordinates(F.translate(ring, "()", ""))))
    return F.when(body == "", F.array().cast("array<array<array<struct<x:double,y:double>>>>")).otherwise(rings)


def wkt_to_rings(wkt) -> Column:
    """The rings of the first part (outer ring and holes); NULL for EMPTY."""
    return F.get(wkt_to_parts(wkt), 0)


def wkt_to_ring(wkt) -> Column:
    """The first ring, for texts known to have one (a LINESTRING's or POINT's points)."""
    return F.get(wkt_to_rings(wkt), 0)


def tile_xy(lon, lat, zoom) -> Column:
    """Web-Mercator tile (x, y) of a lon/lat at zoom z, as ``struct<x,y>`` bigints."""
    n = F.pow(F.lit(2.0), _c(zoom).cast("double"))
    lat_r = F.radians(_c(lat))
    x = F.floor((_c(lon) + F.lit(180.0)) / F.lit(360.0) * n)
    y = F.floor((F.lit(1.0) - F.ln(F.tan(lat_r) + F.lit(1.0) / F.cos(lat_r)) / F.lit(math.pi)) / F.lit(2.0) * n)
    top = n.cast("long") - 1
    return F.struct(
        F.least(F.greatest(x, F.lit(0)), top).alias("x"),
        F.least(F.greatest(y, F.lit(0)), top).alias("y"),
    )


# --- staged forms -------------------------------------------------------------------
# The Column forms above nest every intermediate term, which is fine for a
# few rows but makes large expression trees.  The staged forms add the
# intermediate terms as columns, one projection per stage, so each term is
# computed once per row and the generated code stays small.

def with_utm(df, lon, lat, x_out: str = "x", y_out: str = "y", zone: int = 35, south: bool = True):
    """``df`` plus UTM columns computed from lon/lat columns."""
    keep = [F.col(c) for c in df.columns if c not in (x_out, y_out)]
    lam0 = math.radians(central_meridian(zone))
    e = F.lit(_E)
    s1 = df.select(*keep, F.radians(_c(lat).cast("double")).alias("_phi"),
                   (F.radians(_c(lon).cast("double")) - F.lit(lam0)).alias("_dl"))
    s2 = s1.select(*keep, F.sinh(F.atanh(F.sin("_phi")) - e * F.atanh(e * F.sin("_phi"))).alias("_t"), "_dl")
    s3 = s2.select(*keep, F.atan2(F.col("_t"), F.cos("_dl")).alias("_xi"),
                   F.atanh(F.sin("_dl") / F.sqrt(F.lit(1.0) + F.col("_t") * F.col("_t"))).alias("_eta"))
    xi, eta = F.col("_xi"), F.col("_eta")
    e_sum, n_sum = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        e_sum = e_sum + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        n_sum = n_sum + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    k0a = UTM_K0 * _RECT_A
    return s3.select(*keep, (F.lit(UTM_FALSE_EASTING) + F.lit(k0a) * e_sum).alias(x_out),
                     (F.lit(k0a) * n_sum + F.lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)).alias(y_out))


def with_lonlat(df, x, y, lon_out: str = "lon", lat_out: str = "lat", zone: int = 35, south: bool = True):
    """``df`` plus lon/lat columns computed from UTM x/y columns."""
    keep = [F.col(c) for c in df.columns if c not in (lon_out, lat_out)]
    k0a = UTM_K0 * _RECT_A
    s1 = df.select(*keep,
                   ((_c(y).cast("double") - F.lit(UTM_FALSE_NORTHING_SOUTH if south else 0.0)) / F.lit(k0a)).alias("_xi"),
                   ((_c(x).cast("double") - F.lit(UTM_FALSE_EASTING)) / F.lit(k0a)).alias("_eta"))
    xi, eta = F.col("_xi"), F.col("_eta")
    xp, ep = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xp = xp - F.lit(b) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        ep = ep - F.lit(b) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    s2 = s1.select(*keep, xp.alias("_xp"), ep.alias("_ep"))
    s3 = s2.select(*keep, F.asin(F.sin("_xp") / F.cosh("_ep")).alias("_chi"), "_xp", "_ep")
    chi = F.col("_chi")
    phi = chi
    for j, dd in enumerate(_DELTA, start=1):
        phi = phi + F.lit(dd) * F.sin(F.lit(2.0 * j) * chi)
    lam = F.lit(math.radians(central_meridian(zone))) + F.atan2(F.sinh("_ep"), F.cos("_xp"))
    return s3.select(*keep, F.degrees(lam).alias(lon_out), F.degrees(phi).alias(lat_out))
