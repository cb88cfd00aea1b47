"""Edges of polygons that cross, touch or lie on each other, for rings of any length.

Edges meet in square buckets about as wide as a mean edge, by an equi-join on
(polygon, level, bucket); a bucket that more than ``MOST_EDGES`` edges touch is split
into sixteen, as often as it takes (``MOST_LEVELS`` times at most: edges that all meet
in one point cannot be told apart by buckets).  So a ring costs about its number
of edges, and not the square of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexaccess.functions.polygon import ring_dedup
from hexaccess.operators.edges import as_rings, span
from hexaccess.session import materialise

MOST_EDGES, MOST_LEVELS = 32, 10
_PAD = 1e-9      # of a bucket: an edge is also in the buckets that it misses by rounding only
_CELL = ["_part", "_lv", "_cx", "_cy"]


def _numbered_edges(layer: DataFrame, zone_id: str, rings: str) -> DataFrame:
    """(zone_id, _part, _ring, _e, _last, ax, ay, bx, by): edges by ring and place, without those of repeated points;
    ``_last`` is the place of a closed ring's last edge."""
    parts = layer.select(F.col(zone_id), as_rings(layer, rings).alias("_rings")).withColumn("_part", F.monotonically_increasing_id())
    ring = parts.select(zone_id, "_part", F.posexplode("_rings").alias("_ring", "_r")).withColumn("_r", ring_dedup(F.col("_r")))
    n = F.size("_r")
    closed = (F.get("_r", F.lit(0))["x"] == F.get("_r", n - 1)["x"]) & (F.get("_r", F.lit(0))["y"] == F.get("_r", n - 1)["y"])
    ends = F.arrays_zip(F.slice("_r", F.lit(1), n - 1).alias("a"), F.slice("_r", F.lit(2), n - 1).alias("b"))
    return materialise(
        ring.where(n >= 2).select(zone_id, "_part", "_ring", F.when(closed, n - 2).alias("_last"), F.posexplode(ends).alias("_e", "_v"))
        .select(zone_id, "_part", "_ring", "_e", "_last", F.col("_v.a.x").alias("ax"), F.col("_v.a.y").alias("ay"),
                F.col("_v.b.x").alias("bx"), F.col("_v.b.y").alias("by")), "ring_edges")


def _cells(rows: DataFrame, x0: Column, x1: Column, y0: Column, y1: Column) -> DataFrame:
    """Each row once per bucket (_cx, _cy) of width ``_w`` that its edge touches within the buckets x0..x1, y0..y1."""
    w, pad = F.col("_w"), F.col("_w") * _PAD
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")
    rows = rows.withColumn("_cx", F.explode(span(F.greatest(F.floor((low - pad) / w), x0), F.least(F.floor((high + pad) / w), x1))))
    left, right = F.greatest(low, F.col("_cx") * w), F.least(high, (F.col("_cx") + 1) * w)
    slope = (F.col("by") - F.col("ay")) / F.when(F.col("bx") != F.col("ax"), F.col("bx") - F.col("ax"))
    at = lambda x: F.coalesce(F.col("ay") + slope * (x - F.col("ax")), F.col("ay"))
    whole = high - low <= 2 * pad       # upright: all of its height
    bottom = F.when(whole, F.least("ay", "by")).otherwise(F.greatest(F.least("ay", "by"), F.least(at(left), at(right))))
    above = F.when(whole, F.greatest("ay", "by")).otherwise(F.least(F.greatest("ay", "by"), F.greatest(at(left), at(right))))
    steep = F.when(whole, 0.0).otherwise(F.abs(slope)) * pad + pad
    return rows.withColumn("_cy", F.explode(span(F.greatest(F.floor((bottom - steep) / w), y0), F.least(F.floor((above + steep) / w), y1))))


def bucketed_edges(edges: DataFrame, most: int = MOST_EDGES) -> DataFrame:
    """The edges once per final bucket (_lv, _cx, _cy) that they touch."""
    far = F.lit(1 << 62)
    length = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    width = edges.groupBy("_part").agg(F.greatest(F.avg(length), F.lit(1e-300)).alias("_w"))
    rows = materialise(_cells(edges.join(width, "_part").withColumn("_lv", F.lit(0)), -far, far, -far, far), "edge_buckets")
    done, level = None, 0
    while True:
        heavy = rows.groupBy(*_CELL).count().where(F.col("count") > most).select(*_CELL)
        heavy = materialise(heavy, "heavy_buckets") if level < MOST_LEVELS else None
        if heavy is None or heavy.isEmpty():
            return rows if done is None else done.unionByName(rows)
        calm = rows.join(heavy, _CELL, "left_anti")
        done = calm if done is None else done.unionByName(calm)
        inner = (rows.join(heavy, _CELL, "left_semi").withColumn("_w", F.col("_w") / 4).withColumn("_lv", F.col("_lv") + 1)
                 .withColumnRenamed("_cx", "_ox").withColumnRenamed("_cy", "_oy"))
        rows = materialise(_cells(inner, F.col("_ox") * 4, F.col("_ox") * 4 + 3, F.col("_oy") * 4, F.col("_oy") * 4 + 3)
                           .drop("_ox", "_oy"), "edge_buckets")
        level += 1


def edge_faults(layer: DataFrame, zone_id: str = "admin_id", rings: str = "ring", most: int = MOST_EDGES) -> DataFrame:
    """(zone_id, n_crossings, n_touches, n_overlaps), one row per id, for polygons of a ring or rings (a row per part).

    Counted are pairs of edges of one part.  Crossing: each passes through the other's inside.  Touching: edges of one
    ring that meet otherwise than neighbours do at their common point; a spike, where the ring turns back on itself,
    is one.  Overlapping: edges of two rings that share a piece of a line.  A hole that touches the outer ring in
    points is no fault.  Repeated points and unclosed ends are not looked at here; no ring, or a null one, has no faults.
    """
    edges = _numbered_edges(layer, zone_id, rings)
    placed = bucketed_edges(edges, most)
    side = lambda s: placed.select(*_CELL, F.col(zone_id).alias(f"_zone{s}"), *[
        F.col(c).alias(f"{c}{s}") for c in ("_ring", "_e", "_last", "ax", "ay", "bx", "by")])
    later = (F.col("_ring2") > F.col("_ring1")) | ((F.col("_ring2") == F.col("_ring1")) & (F.col("_e2") > F.col("_e1")))
    pairs = side(1).join(side(2).drop("_zone2"), _CELL).where(later)

    def turn(p: str, q: str, r: str) -> Column:
        """The side of the line from p to q on which r lies."""
        (px, py), (qx, qy), (rx, ry) = ((F.col(f"{c[0]}x{c[1]}"), F.col(f"{c[0]}y{c[1]}")) for c in (p, q, r))
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    def between(p: str, q: str, r: str) -> Column:
        inside = [F.col(f"{r[0]}{d}{r[1]}").between(F.least(f"{p[0]}{d}{p[1]}", f"{q[0]}{d}{q[1]}"),
                                                    F.greatest(f"{p[0]}{d}{p[1]}", f"{q[0]}{d}{q[1]}")) for d in "xy"]
        return inside[0] & inside[1]

    def shared(d: str) -> Column:
        """Whether the two edges' extents along an axis share more than a point."""
        return (F.greatest(F.least(f"a{d}1", f"b{d}1"), F.least(f"a{d}2", f"b{d}2"))
                < F.least(F.greatest(f"a{d}1", f"b{d}1"), F.greatest(f"a{d}2", f"b{d}2")))

    turns = {"_o1": ("a1", "b1", "a2"), "_o2": ("a1", "b1", "b2"), "_o3": ("a2", "b2", "a1"), "_o4": ("a2", "b2", "b1")}
    pairs = pairs.withColumns({name: turn(*points) for name, points in turns.items()})
    same = F.col("_ring1") == F.col("_ring2")
    after = same & (F.col("_e2") == F.col("_e1") + 1)
    around = same & (F.col("_e1") == 0) & F.coalesce(F.col("_e2") == F.col("_last1"), F.lit(False)) & (F.col("_e2") > 0)
    crossing = (F.col("_o1") * F.col("_o2") < 0) & (F.col("_o3") * F.col("_o4") < 0)
    meeting = F.lit(False)
    for name, (p, q, r) in turns.items():
        meeting = meeting | ((F.col(name) == 0) & between(p, q, r))
    in_line = (F.col("_o1") == 0) & (F.col("_o2") == 0)
    piece = in_line & (shared("x") | shared("y"))
    kind = (F.when(after | around, F.when(piece, "touch"))
            .when(crossing, "crossing").when(same & meeting, "touch").when(~same & piece, "overlap"))
    found = (pairs.withColumn("_kind", kind).where("_kind IS NOT NULL")
             .select(F.col("_zone1").alias(zone_id), "_part", "_ring1", "_e1", "_ring2", "_e2", "_kind").distinct())
    counts = found.groupBy(zone_id).agg(*[F.count_if(F.col("_kind") == k).alias(c) for k, c in
                                          (("crossing", "n_crossings"), ("touch", "n_touches"), ("overlap", "n_overlaps"))])
    return layer.select(zone_id).distinct().join(counts, zone_id, "left").na.fill(0, ["n_crossings", "n_touches", "n_overlaps"])
