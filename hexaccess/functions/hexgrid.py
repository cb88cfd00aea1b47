"""Hexagon grid maths (pointy-top hexagons in a planar CRS) as Columns.

A hexagon is addressed by axial coordinates (q, r) at a resolution
level; its id is the text ``"<res>_<q>_<r>"``.  Assigning a point to its
hexagon is pure arithmetic, so zonal sums become an equi-group on the
id and need no spatial join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexaccess.functions.geo import _c, point

SQRT3 = math.sqrt(3.0)
# Fixed value: mean hexagon area at level 0 of the common global hexagon
# ladder (km^2); each level divides the area by 7.
LEVEL0_AREA_KM2 = 4357449.416078383


def hex_area_km2(res: int) -> float:
    return LEVEL0_AREA_KM2 / (7.0 ** res)


def hex_edge_m(res: int) -> float:
    """Edge length (= circumradius) in metres of a regular hexagon of the level's area."""
    area_m2 = hex_area_km2(res) * 1.0e6
    return math.sqrt(2.0 * area_m2 / (3.0 * SQRT3))


def _round_half_up(v: Column) -> Column:
    return F.floor(v + F.lit(0.5))


def hex_axial(x, y, res: int) -> Column:
    """Axial (q, r) of the hexagon containing planar point (x, y): ``struct<q,r>`` bigints."""
    s = hex_edge_m(res)
    fq = (F.lit(SQRT3 / 3.0) * _c(x) - _c(y) / F.lit(3.0)) / F.lit(s)
    fr = (F.lit(2.0 / 3.0) * _c(y)) / F.lit(s)
    fs = -fq - fr
    rq, rr, rs = _round_half_up(fq), _round_half_up(fr), _round_half_up(fs)
    dq, dr, ds = F.abs(rq - fq), F.abs(rr - fr), F.abs(rs - fs)
    q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    r = F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -rq - rs).otherwise(rr)
    return F.struct(q.cast("long").alias("q"), r.cast("long").alias("r"))


def hex_id(res, q, r) -> Column:
    return F.concat_ws("_", _c(res).cast("string"), _c(q).cast("string"), _c(r).cast("string"))


def hex_assign(x, y, res: int) -> Column:
    """Id of the hexagon (at ``res``) whose area contains planar point (x, y)."""
    a = hex_axial(x, y, res)
    return hex_id(F.lit(res), a["q"], a["r"])


def hex_center(q, r, res: int) -> Column:
    """Planar centre of hexagon (q, r) as ``struct<x,y>``."""
    s = hex_edge_m(res)
    qd, rd = _c(q).cast("double"), _c(r).cast("double")
    return point(F.lit(s * SQRT3) * (qd + rd / F.lit(2.0)), F.lit(1.5 * s) * rd)


def parse_hex_id(hid) -> Column:
    """``"res_q_r"`` -> ``struct<res int, q long, r long>``."""
    parts = F.split(_c(hid), "_")
    return F.struct(
        F.get(parts, 0).cast("int").alias("res"),
        F.get(parts, 1).cast("long").alias("q"),
        F.get(parts, 2).cast("long").alias("r"),
    )


def hex_boundary(q, r, res: int) -> Column:
    """Closed ring (7 points, counter-clockwise) of hexagon (q, r)."""
    s = hex_edge_m(res)
    c = hex_center(q, r, res)
    # vertex i sits at angle 30 + 60*i degrees; i = 6 closes the ring
    return F.transform(
        F.sequence(F.lit(0), F.lit(6)),
        lambda i: point(
            c["x"] + F.lit(s) * F.cos(F.radians(F.lit(30.0) + F.lit(60.0) * (i % 6))),
            c["y"] + F.lit(s) * F.sin(F.radians(F.lit(30.0) + F.lit(60.0) * (i % 6))),
        ),
    )


def hex_candidate_rows(ymin, ymax, res: int, pad: int = 1) -> Column:
    """Axial r values whose hexagon centres can lie in [ymin, ymax]."""
    s = hex_edge_m(res)
    lo = F.floor(_c(ymin) / F.lit(1.5 * s)) - pad
    hi = F.ceil(_c(ymax) / F.lit(1.5 * s)) + pad
    return F.sequence(lo, hi)


def hex_candidate_cols(xmin, xmax, r, res: int, pad: int = 1) -> Column:
    """Axial q values whose hexagon centres in row r can lie in [xmin, xmax]."""
    s = hex_edge_m(res)
    rd = _c(r).cast("double")
    lo = F.floor(_c(xmin) / F.lit(s * SQRT3) - rd / F.lit(2.0)) - pad
    hi = F.ceil(_c(xmax) / F.lit(s * SQRT3) - rd / F.lit(2.0)) + pad
    return F.sequence(lo, hi)


def parent_res_axial(x, y, res: int) -> Column:
    """Axial coordinates of the coarser (res - 1) hexagon containing a centre."""
    return hex_axial(x, y, res - 1)


def with_hex_axial(df, x, y, res: int):
    """Staged form of ``hex_axial``: fractional axial coordinates, then the
    cube rounding, each computed once per row; adds longs ``q`` and ``r``,
    the keys to group by (ids are text, for results)."""
    keep = [F.col(c) for c in df.columns if c not in ("q", "r")]
    s = hex_edge_m(res)
    s1 = df.select(*keep, ((F.lit(SQRT3 / 3.0) * _c(x) - _c(y) / F.lit(3.0)) / F.lit(s)).alias("_fq"),
                   ((F.lit(2.0 / 3.0) * _c(y)) / F.lit(s)).alias("_fr"))
    fq, fr = F.col("_fq"), F.col("_fr")
    s2 = s1.select(*keep, "_fq", "_fr", (-fq - fr).alias("_fs"), _round_half_up(fq).alias("_rq"),
                   _round_half_up(fr).alias("_rr"), _round_half_up(-fq - fr).alias("_rs"))
    rq, rr, rs = F.col("_rq"), F.col("_rr"), F.col("_rs")
    s3 = s2.select(*keep, "_rq", "_rr", "_rs", F.abs(rq - fq).alias("_dq"), F.abs(rr - fr).alias("_dr"),
                   F.abs(rs - F.col("_fs")).alias("_ds"))
    dq, dr, ds = F.col("_dq"), F.col("_dr"), F.col("_ds")
    q_wins = (dq > dr) & (dq > ds)
    return s3.select(*keep, F.when(q_wins, -rr - rs).otherwise(rq).cast("long").alias("q"),
                     F.when(~q_wins & (dr > ds), -rq - rs).otherwise(rr).cast("long").alias("r"))


def with_hex_assign(df, x, y, res: int, out: str = "hex_id"):
    """``df`` plus the id of the hexagon that holds (x, y)."""
    keep = [c for c in df.columns if c not in (out, "q", "r")]
    return with_hex_axial(df.select(*keep), x, y, res).select(*keep, hex_id(F.lit(res), F.col("q"), F.col("r")).alias(out))


def hex_boundary_of_id(hid, max_res: int = 15) -> Column:
    """Closed ring of a hexagon given only its id ``"res_q_r"`` (the level
    is read from the id; edge lengths come from a literal per-level table)."""
    p = parse_hex_id(hid)
    edges = F.array(*[F.lit(hex_edge_m(k)) for k in range(max_res + 1)])
    s = F.element_at(edges, p["res"] + 1)
    qd, rd = p["q"].cast("double"), p["r"].cast("double")
    cx = s * F.lit(SQRT3) * (qd + rd / F.lit(2.0))
    cy = F.lit(1.5) * s * rd
    return F.transform(
        F.sequence(F.lit(0), F.lit(6)),
        lambda i: point(cx + s * F.cos(F.radians(F.lit(30.0) + F.lit(60.0) * (i % 6))),
                        cy + s * F.sin(F.radians(F.lit(30.0) + F.lit(60.0) * (i % 6)))),
    )
