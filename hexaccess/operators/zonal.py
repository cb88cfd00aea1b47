"""Zonal sums: values at points (raster cell centres) summed per zone.

A cell counts for a zone when its centre is inside the zone (no partial
coverage).  Hexagon zones need no spatial join at all: the hexagon of a
point is arithmetic, so the sum is one partially-aggregated ``groupBy``.
Arbitrary polygons (holes and parts included) use a bucket equi-join in
which only border buckets carry edges, and buckets with many are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexaccess.functions import hexgrid
from hexaccess.operators.edges import cross_at, inside_runs, polygon_edges, span
from hexaccess.session import materialise


def zonal_hex(points: DataFrame, res: int, values: dict[str, object], x: str = "x",
              y: str = "y") -> DataFrame:
    """Sum each value expression per hexagon: ``(hex_id, <name>...)``.

    ``values`` maps output names to Column expressions (or column names).
    Map-side partial sums mean a dense hexagon costs one row per task, so
    hot hexagons do not skew the shuffle; the key is (q, r), ids are
    written after the sums.
    """
    aggs = [F.sum(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in values.items()]
    sums = hexgrid.with_hex_axial(points, x, y, res).groupBy("q", "r").agg(*aggs)
    return sums.select(hexgrid.hex_id(F.lit(res), F.col("q"), F.col("r")).alias("hex_id"), *values)


def zonal_polygon(points: DataFrame, zones: DataFrame, bucket_m: float, value: str = "value",
                  x: str = "x", y: str = "y", zone_id: str = "zone_id", ring: str = "ring") -> DataFrame:
    """Sum of ``value`` over points whose location is inside each zone ring:
    ``(zone_id, value_sum, n_points)``; zones with no point get no row."""
    hit = point_in_zone(points.select(x, y, value), zones, bucket_m, x, y, zone_id, ring)
    return hit.groupBy(zone_id).agg(F.sum(value).alias("value_sum"), F.count(F.lit(1)).alias("n_points"))


#: A bucket with more edges is split in ``SPLIT`` x ``SPLIT``, down to ``DEEPEST`` levels (edges that share a point can't be parted).
MOST_EDGES, SPLIT, DEEPEST = 32, 4, 12


def turns_between(px, py, cx, cy, e) -> Column:
    """How often the way from (px, py) along its line to cx, then up or down to cy, crosses an edge."""
    at_y = cross_at(py, e["ax"], e["ay"], e["bx"], e["by"])
    at_x = cross_at(cx, e["ay"], e["ax"], e["by"], e["bx"])
    one = lambda crossed: F.when(F.coalesce(crossed, F.lit(False)), 1).otherwise(0)
    return one((px < at_y) != (cx < at_y)) + one((py < at_x) != (cy < at_x))


def rows_of(edges: DataFrame, b: float, least=None, most=None) -> DataFrame:
    """One row for each bucket row (``_gy``, from least to most) that an edge touches."""
    lo, hi = F.floor(F.least("ay", "by") / b), F.floor(F.greatest("ay", "by") / b)
    lo, hi = (lo, hi) if least is None else (F.greatest(lo, least), F.least(hi, most))
    return edges.select("*", F.explode(span(lo, hi)).alias("_gy"))


def columns_of(rows: DataFrame, b: float, least=None, most=None) -> DataFrame:
    """One row for each bucket (``_gx``, from least to most) of its bucket row that an edge touches, a little widened against rounding."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    lo_y, hi_y = F.greatest(F.col("_gy") * b, F.least(ay, by)), F.least((F.col("_gy") + 1) * b, F.greatest(ay, by))
    x_at = lambda v: F.when(ay == by, ax).otherwise(ax + (bx - ax) * (v - ay) / F.when(ay != by, by - ay))
    ends = [F.when(ay == by, bx).otherwise(x_at(hi_y)), x_at(lo_y)]
    slack = b * 1e-9
    lo, hi = F.floor((F.least(*ends) - slack) / b), F.floor((F.greatest(*ends) + slack) / b)
    lo, hi = (lo, hi) if least is None else (F.greatest(lo, least), F.least(hi, most))
    return rows.select("*", F.explode(span(lo, hi)).alias("_gx"))


def centres_within(rows: DataFrame, b: float, zone_col: str) -> DataFrame:
    """(zone_col, _part, _gy, _gx, _in: true): the buckets whose centres are inside a zone, by the crossings of
    each bucket row's centre line with the edges in it (``rows_of``)."""
    keys = [zone_col, "_part", "_gy"]
    middle = (F.col("_gy").cast("double") + 0.5) * b
    crossings = rows.select(*keys, cross_at(middle, *[F.col(c) for c in ("ax", "ay", "bx", "by")]).alias("_x")).where("_x IS NOT NULL")
    columns = span(F.ceil(F.col("lo") / b - 0.5), F.ceil(F.col("hi") / b - 0.5) - 1)
    return inside_runs(crossings, keys, "_x").select(*keys, F.explode(columns).alias("_gx")).withColumn("_in", F.lit(True))


def zone_buckets(zones: DataFrame, bucket_m: float, zone_id: str = "zone_id", ring: str = "ring", most: int = MOST_EDGES) -> DataFrame:
    """(_zid, _part, _lv, _gx, _gy, _in, _edges): the buckets that a zone's border touches or that are inside it.

    At level 0 the plane is cut into square buckets of edge ``bucket_m``.  Whether a bucket's centre is inside a
    zone follows by parity from the crossings of the zone's edges with the line through the bucket row's
    centres.  A bucket that more than ``most`` edges touch is no leaf: its edges, still a row each, are dealt to
    smaller buckets one level down, whose centres are inside or not by the parent's centre and the edges between
    the two.  Only leaves collect their edges, so an array holds ``most`` at the most (but for edges that meet in one point).
    """
    b, key = float(bucket_m), ["_zid", "_part", "_gx", "_gy"]
    edge = ["ax", "ay", "bx", "by"]
    edges = polygon_edges(zones.select(F.col(zone_id).alias("_zid"), ring), "_zid", ring)
    rows = rows_of(edges, b)
    within = centres_within(rows, b, "_zid")
    touched = materialise(columns_of(rows, b).select(*key, *edge), "touched")
    sides = materialise(touched.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).join(within, key, "full")
                        .select(*key, F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_in", F.lit(False)).alias("_in")), "sides")
    leaves, level = None, 0
    while True:
        dense = (F.col("_n") > most) if level < DEEPEST else F.lit(False)
        ready = sides.where(~dense)
        lists = touched.join(ready.where("_n > 0"), key, "left_semi").groupBy(*key).agg(F.collect_list(F.struct(*edge)).alias("_edges"))
        found = (ready.where("_n > 0 OR _in").join(lists, key, "left").select("_zid", "_part", F.lit(level).alias("_lv"), "_gx", "_gy", "_in", "_edges"))
        leaves = found if leaves is None else leaves.unionByName(found)
        split = sides.where(dense)
        if split.isEmpty():
            return leaves
        level, parent, b = level + 1, b, b / SPLIT
        inside = touched.join(split.select(*key, "_in"), key).withColumnsRenamed({"_gx": "_px", "_gy": "_py"})
        down = F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1)))
        centres = inside.select("*", down.alias("_i")).select("*", down.alias("_j")).select(
            "_zid", "_part", "_in", *edge, "_px", "_py", (F.col("_px") * SPLIT + F.col("_i")).alias("_gx"), (F.col("_py") * SPLIT + F.col("_j")).alias("_gy"))
        centre = lambda c, size: (F.col(c).cast("double") + 0.5) * size
        turns = turns_between(centre("_gx", b), centre("_gy", b), centre("_px", parent), centre("_py", parent), {c: F.col(c) for c in edge})
        parity = centres.groupBy(*key).agg((F.first("_in") != (F.sum(turns) % 2 == 1)).alias("_in"))
        first = lambda c: F.col(c) * SPLIT
        smaller = columns_of(rows_of(inside, b, first("_py"), first("_py") + SPLIT - 1), b, first("_px"), first("_px") + SPLIT - 1)
        touched = materialise(smaller.select(*key, *edge), "touched")
        counts = touched.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        sides = materialise(parity.join(counts, key, "left").select(*key, F.coalesce("_n", F.lit(0)).alias("_n"), "_in"), "sides")


def point_in_zone(points: DataFrame, zones: DataFrame, bucket_m: float, x: str = "x", y: str = "y",
                  zone_id: str = "zone_id", ring: str = "ring", most: int = MOST_EDGES) -> DataFrame:
    """Tag each point with the zone(s) containing it (inner: points outside every zone drop).

    Points meet the zones' buckets (``zone_buckets``) by an equi-join on level and bucket.  A bucket without edges is
    wholly inside; else a point's side is that of the bucket's centre, turned over by each edge between the two.
    No ring is shipped, a point is tested against ``most`` edges of a zone at the most, and only points in
    buckets that were split look at finer levels.
    """
    b = float(bucket_m)
    buckets = materialise(zone_buckets(zones, b, zone_id, ring, most), "buckets")
    px, py = F.col(x), F.col(y)
    pts = points.withColumn("_gx", F.floor(px / b).cast("long")).withColumn("_gy", F.floor(py / b).cast("long"))
    deepest = buckets.agg(F.max("_lv")).first()[0]
    if deepest:
        up = lambda c: F.floor(F.col(c) / F.pow(F.lit(float(SPLIT)), F.col("_lv"))).cast("long").alias(c)
        depth = buckets.where("_lv > 0").select(up("_gx"), up("_gy"), "_lv").groupBy("_gx", "_gy").agg(F.max("_lv").alias("_deep"))
        size = F.lit(b) / F.pow(F.lit(float(SPLIT)), F.col("_lv"))
        pts = (pts.join(depth, ["_gx", "_gy"], "left").withColumn("_lv", F.explode(F.sequence(F.lit(0), F.coalesce("_deep", F.lit(0))))).drop("_deep")
               .withColumn("_gx", F.floor(px / size).cast("long")).withColumn("_gy", F.floor(py / size).cast("long")))
    else:
        pts, size = pts.withColumn("_lv", F.lit(0)), F.lit(b)
    cx, cy = (F.col("_gx").cast("double") + 0.5) * size, (F.col("_gy").cast("double") + 0.5) * size
    odd = F.aggregate(F.coalesce(F.col("_edges"), F.array().cast(buckets.schema["_edges"].dataType)), F.lit(0),
                      lambda n, e: n + turns_between(px, py, cx, cy, e)) % 2 == 1
    hit = pts.join(buckets, ["_lv", "_gx", "_gy"]).where(F.col("_in") != odd)
    return hit.select(*points.columns, F.col("_zid").alias(zone_id))
