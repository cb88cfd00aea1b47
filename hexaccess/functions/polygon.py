"""Ring and polygon predicates/measures as Column expressions.

Loops over vertices use Spark higher-order functions (``aggregate``,
``transform``, ``exists``) on the ring array, so they run in the JVM
next to the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexaccess.functions.geo import _c, point


def _edges(ring: Column) -> Column:
    """Edge start indexes 0 .. n-2; NULL for rings with fewer than 2 points
    (``sequence`` would otherwise count down)."""
    return F.when(F.size(ring) >= 2, F.sequence(F.lit(0), F.size(ring) - 2))


def _v(ring: Column, i) -> Column:
    return F.get(ring, i)


def ring_crossings(px, py, ring) -> Column:
    """Number of ring edges a ray from (px, py) towards +x crosses."""
    ring, px, py = _c(ring), _c(px), _c(py)

    def step(acc, i):
        a, b = _v(ring, i), _v(ring, i + 1)
        straddles = (a["y"] > py) != (b["y"] > py)
        dy = F.when(straddles, b["y"] - a["y"])  # NULL unless it straddles: no 0 divisor
        x_cross = (b["x"] - a["x"]) * (py - a["y"]) / dy + a["x"]
        return acc + F.when(straddles & (px < x_cross), 1).otherwise(0)

    return F.when(F.size(ring) >= 2, F.aggregate(_edges(ring), F.lit(0), step)).otherwise(0)


def point_in_ring(px, py, ring) -> Column:
    """Even-odd ray cast against a closed ring (last vertex = first).
    Points exactly on an edge follow the half-open straddle rule, so a point
    on an edge shared by two neighbouring rings falls in exactly one."""
    return (ring_crossings(px, py, ring) % 2) == 1


def point_in_polygon(px, py, rings) -> Column:
    """Even-odd rule over all rings (outer + holes) of a polygon."""
    total = F.aggregate(_c(rings), F.lit(0), lambda acc, ring: acc + ring_crossings(px, py, ring))
    return (total % 2) == 1


def signed_area(ring) -> Column:
    ring = _c(ring)
    cross = F.aggregate(
        _edges(ring), F.lit(0.0),
        lambda acc, i: acc + (_v(ring, i)["x"] * _v(ring, i + 1)["y"]
                              - _v(ring, i + 1)["x"] * _v(ring, i)["y"]),
    )
    return cross / F.lit(2.0)


def polygon_area(ring) -> Column:
    """Shoelace area in squared input units."""
    return F.abs(signed_area(ring))


def polygon_centroid(ring) -> Column:
    """Area-weighted centroid ``struct<x,y>`` of a simple closed ring."""
    ring = _c(ring)
    a6 = signed_area(ring) * F.lit(6.0)

    def moment(axis):
        return F.aggregate(
            _edges(ring), F.lit(0.0),
            lambda acc, i: acc + (_v(ring, i)[axis] + _v(ring, i + 1)[axis]) * (
                _v(ring, i)["x"] * _v(ring, i + 1)["y"] - _v(ring, i + 1)["x"] * _v(ring, i)["y"]),
        )

    safe = F.when(a6 != 0, a6)
    return point(moment("x") / safe, moment("y") / safe)


def rings_area(rings) -> Column:
    """Area of a polygon: its outer ring's, less that of its holes."""
    areas = F.array(F.transform(_c(rings), lambda r: F.abs(signed_area(r))))   # bound below by a lambda, so computed once
    return F.get(F.transform(areas, lambda a: F.get(a, 0) - F.aggregate(
        F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), F.lit(0.0), lambda t, hole: t + hole)), 0)


def rings_centroid(rings) -> Column:
    """Centroid of a polygon with holes: that of its rings, holes counting against."""
    parts = F.transform(_c(rings), lambda r, i: F.struct(
        (F.abs(signed_area(r)) * F.when(i == 0, 1.0).otherwise(-1.0)).alias("w"), polygon_centroid(r).alias("c")))
    total = lambda f: F.aggregate(parts, F.lit(0.0), lambda t, p: t + f(p))
    w = total(lambda p: p["w"])
    safe = F.when(w != 0, w)
    return point(total(lambda p: p["w"] * p["c"]["x"]) / safe, total(lambda p: p["w"] * p["c"]["y"]) / safe)


def ring_bbox(ring) -> Column:
    """``struct<xmin,ymin,xmax,ymax>`` of a ring's vertices."""
    ring = _c(ring)
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
    )


def ring_closed(ring) -> Column:
    ring = _c(ring)
    first, last = F.get(ring, 0), F.get(ring, F.size(ring) - 1)
    return (F.size(ring) >= 1) & (first["x"] == last["x"]) & (first["y"] == last["y"])


def _segments_cross(a, b, c, d) -> Column:
    """Proper crossing test of segments a-b and c-d (orientation signs)."""
    def orient(p, q, r):
        return (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])

    o1, o2 = orient(a, b, c), orient(a, b, d)
    o3, o4 = orient(c, d, a), orient(c, d, b)
    return (o1 * o2 < 0) & (o3 * o4 < 0)


def ring_self_crosses(ring) -> Column:
    """True when two non-adjacent edges cross (pairwise test with ``exists``)."""
    ring = _c(ring)
    n_edges = F.size(ring) - 1
    return F.exists(
        _edges(ring),
        lambda i: F.exists(
            F.sequence(i + 2, F.greatest(n_edges - 1, i + 2)),
            lambda j: (j < n_edges) & ~((i == 0) & (j == n_edges - 1))
            & _segments_cross(_v(ring, i), _v(ring, i + 1), _v(ring, j), _v(ring, j + 1)),
        ),
    )


def ring_valid(ring) -> Column:
    """Closed, at least 4 points, non-zero area and no self-crossing."""
    ring = _c(ring)
    return (
        ring_closed(ring) & (F.size(ring) >= 4) & (signed_area(ring) != 0) & ~ring_self_crosses(ring)
    ).alias("valid")


def ring_dedup(ring) -> Column:
    """Drop vertices equal to their predecessor."""
    ring = _c(ring)
    idx = F.sequence(F.lit(0), F.size(ring) - 1)
    kept = F.filter(
        idx,
        lambda i: (i == 0) | (_v(ring, i)["x"] != _v(ring, i - 1)["x"])
        | (_v(ring, i)["y"] != _v(ring, i - 1)["y"]),
    )
    return F.transform(kept, lambda i: _v(ring, i))


def ring_close(ring) -> Column:
    """Append the first vertex when the ring is not closed."""
    ring = _c(ring)
    first, last = F.get(ring, 0), F.get(ring, F.size(ring) - 1)
    return F.when((first["x"] == last["x"]) & (first["y"] == last["y"]), ring).otherwise(
        F.concat(ring, F.array(first)))


def ring_orient_ccw(ring) -> Column:
    ring = _c(ring)
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def with_barrier(df, col: str):
    """Re-emit ``col`` through a one-element ``explode`` so later filters and
    projections reference a generator output instead of inlining the whole
    expression that built it (filter pushdown through projections would
    otherwise copy deep array expressions into every reference)."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(F.array(F.col(col))).alias(col))


def with_ring_repair(df, ring: str = "ring"):
    """Drop consecutive duplicate vertices, close the ring and orient it
    counter-clockwise, one projection per step (each step reads the
    previous column, so expressions stay small).  Self-crossing rings are
    not untangled (see ``ring_self_crosses``); callers route them to a
    reject table."""
    out = with_barrier(df.withColumn(ring, ring_dedup(F.col(ring))), ring)
    out = with_barrier(out.withColumn(ring, ring_close(F.col(ring))), ring)
    return with_barrier(out.withColumn(ring, ring_orient_ccw(F.col(ring))), ring)


def clip_ring_halfplane(ring, axis: str, bound, keep_greater: bool) -> Column:
    """One Sutherland-Hodgman pass: keep the part of a closed ring on one
    side of the line ``axis = bound``.  Returns a closed ring (may be empty)."""
    ring = _c(ring)
    bound = _c(bound)
    other = "y" if axis == "x" else "x"

    def inside(p):
        return (p[axis] >= bound) if keep_greater else (p[axis] <= bound)

    def cross_point(a, b):
        t = (bound - a[axis]) / F.when(b[axis] != a[axis], b[axis] - a[axis])
        o = a[other] + t * (b[other] - a[other])
        return point(bound, o) if axis == "x" else point(o, bound)

    empty = F.array().cast("array<struct<x:double,y:double>>")

    def kept(i):
        a, b = _v(ring, i), _v(ring, i + 1)
        return (
            F.when(inside(a) & inside(b), F.array(b))
            .when(inside(a) & ~inside(b), F.array(cross_point(a, b)))
            .when(~inside(a) & inside(b), F.array(cross_point(a, b), b))
            .otherwise(empty)
        )

    # one short array per edge, joined once: linear in the ring's length
    out = F.coalesce(F.flatten(F.transform(_edges(ring), kept)), empty)
    first = F.get(out, 0)
    return F.when(F.size(out) == 0, empty).otherwise(F.concat(out, F.array(first)))


def clip_to_box(ring, west, south, east, north) -> Column:
    """Intersection of a closed ring with an axis-aligned box (4 passes)."""
    r = clip_ring_halfplane(ring, "x", west, True)
    r = clip_ring_halfplane(r, "x", east, False)
    r = clip_ring_halfplane(r, "y", south, True)
    r = clip_ring_halfplane(r, "y", north, False)
    return r
