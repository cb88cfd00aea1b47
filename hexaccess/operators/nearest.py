"""Exact k-nearest facility search without a cross join.

Facilities are counted in square buckets on a ladder of levels (bucket edge
``b0 * 4**level``) that reaches from far below the mean spacing to the whole
extent; each occupied bucket keeps its count and the bounding box of its
facilities.  Points are searched in groups, the points of one
bucket with the box around them, so bounds cost a row per group and not per point:

1. A group starts as a bucket of the mean spacing.  Its start level is the finest, from
   there up, whose 3x3 block around that bucket holds ``k`` facilities.  They bound the
   k-th distance of all its points by ``U = 2*sqrt(2)*edge``.
2. The frontier is the occupied buckets of that level that come within U of the
   group's box.  The boxes tighten U: some facility lies on each side of a box
   (k = 1), and all of a box's facilities lie within its far corner (any k).
   Buckets beyond U go.
3. Groups whose frontier still holds more than ``MOST_PAIRS`` facilities descend:
   the group is split into its sub-buckets, each frontier bucket into its occupied
   ones, U tightens, buckets go.  So points beside or inside a dense town meet only
   the buckets near their own answers.
4. The facilities of a group's frontier are paired with its points and ranked.

Every step is an equi-join on ``(level, bucket_x, bucket_y)`` and a window or sum per
group over a bounded number of rows; a round's groups are a written table.  The points
themselves move once, to their group's facilities.
Co-located facilities are merged first (k = 1: the smallest id; k > 1: the k
smallest ids, by a salted two-phase top-k), so a location holding many costs at
most k rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from hexaccess.operators.topk import top_k_per_group
from hexaccess.session import materialise

EARTH_SPAN_M = 4.0e7        # a bucket of this edge covers any planar extent we use
FINER_LEVELS = 5            # levels below the mean spacing (a factor of 4 each)
MOST_PAIRS = 128            # facilities a group may be paired with before it descends
_SLACK = 1.0 + 1e-9         # keeps bounds on the safe side of rounding


def _spacing(found: dict, k: int) -> float:
    """Mean spacing of k of n facilities within the box x0..y1."""
    area = max((found["x1"] - found["x0"]) * (found["y1"] - found["y0"]), 0.0)
    return max(math.sqrt(area * max(k, 1) / found["n"]) if area > 0 else 1000.0, 1.0)


def _written(df: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
    """A written table and aggregates taken while it was written (a repeated task may count twice: they steer
    the search, no result depends on them but on whether there is a row)."""
    seen = Observation()
    table = materialise(df.observe(seen, *[c.alias(n) for n, c in measures.items()]), name)
    return table, seen.get


def _up(c: str, levels) -> F.Column:
    """The bucket that many levels up: floor division by 4 ** levels."""
    return F.call_function("shiftright", F.col(c), (F.lit(2) * levels).cast("int"))


_GROUP = ["_gl", "_gx", "_gy"]
_BOX = ["_px1", "_px2", "_py1", "_py2"]


def _box_bounds(df: DataFrame, k: int) -> DataFrame:
    """Squared distances that hold for all points of a group's box (_px1.._py2) to a facility box (_x1.._y2): at
    least ``_min2``, at most ``_max2``, and ``_sure2`` within which at least one of the facilities lies."""
    def along(p1, p2, x1, x2):
        p1, p2, x1, x2 = (F.col(c) for c in (p1, p2, x1, x2))
        gap = F.greatest(x1 - p2, p1 - x2, F.lit(0.0))
        to_low, to_high = F.greatest(F.abs(p1 - x1), F.abs(p2 - x1)), F.greatest(F.abs(p1 - x2), F.abs(p2 - x2))
        return gap, F.greatest(to_low, to_high), F.least(to_low, to_high)

    (gx, fx, sx), (gy, fy, sy) = along("_px1", "_px2", "_x1", "_x2"), along("_py1", "_py2", "_y1", "_y2")
    out = df.withColumn("_min2", gx * gx + gy * gy).withColumn("_max2", fx * fx + fy * fy)
    return out.withColumn("_sure2", F.least(sx * sx + fy * fy, fx * fx + sy * sy)) if k == 1 else out


def _pruned(rows: DataFrame, k: int) -> DataFrame:
    """Frontier rows with the bound ``_u2`` tightened, without the buckets beyond it, and ``_left``, what they hold per group."""
    group = Window.partitionBy(*_GROUP)
    rows = _box_bounds(rows, k)
    if k == 1:
        bound = F.min("_sure2").over(group)
    else:
        held = F.sum("_n").over(group.orderBy("_max2").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        rows = rows.withColumn("_held", held)
        bound = F.min(F.when(F.col("_held") >= k, F.col("_max2"))).over(group)
    rows = rows.withColumn("_u2", F.least(F.col("_u2"), F.coalesce(bound, F.col("_u2")) * F.lit(_SLACK)))
    near = rows.where(F.col("_min2") <= F.col("_u2"))
    return near.withColumn("_left", F.sum("_n").over(group)).select(
        *_GROUP, *_BOX, "_lv", "_cx", "_cy", "_u2", "_left")


def nearest(points: DataFrame, facilities: DataFrame, *, k: int = 1,
            point_id: str = "hex_id", px: str = "x", py: str = "y",
            fac_id: str = "id", fx: str = "x", fy: str = "y",
            base_cell: float | None = None, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """k nearest facilities of every point.

    Returns ``(point_id, rank, facility_id, distance_m)``; ties are broken
    by the smaller facility id.  Points with no facility get no row (join
    back with ``left`` to keep them with NULLs).  Runs jobs (the rounds)
    while the frame is being built.
    """
    pairs = candidate_pairs(points, facilities, k=k, point_id=point_id, px=px, py=py, fac_id=fac_id, fx=fx, fy=fy,
                            base_cell=base_cell, most_pairs=most_pairs)
    if pairs is None:
        return points.sparkSession.createDataFrame(
            [], f"{point_id} {points.schema[point_id].dataType.simpleString()}, rank int, "
                f"facility_id {facilities.schema[fac_id].dataType.simpleString()}, distance_m double")
    if k == 1:
        # of equally near ones the smallest id, then the nearest: two hashed sums, no sort of pairs
        res = (pairs.groupBy("_pid", "_d2").agg(F.min("_fid").alias("_fid"))
               .groupBy("_pid").agg(F.min_by("_fid", "_d2").alias("_fid"), F.min("_d2").alias("_d2"))
               .withColumn("rank", F.lit(1)))
    else:
        w = Window.partitionBy("_pid").orderBy("_d2", "_fid")
        res = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return res.select(
        F.col("_pid").alias(point_id), F.col("rank").cast("int").alias("rank"),
        F.col("_fid").alias("facility_id"), F.sqrt(F.col("_d2")).alias("distance_m"))


def candidate_pairs(points: DataFrame, facilities: DataFrame, *, k: int, point_id: str, px: str, py: str,
                    fac_id: str, fx: str, fy: str, base_cell: float | None, most_pairs: int) -> DataFrame | None:
    """(_pid, _fid, _d2): for each point some pairs, its k nearest among them; None without facilities."""
    P = points.select(F.col(point_id).alias("_pid"), F.col(px).cast("double").alias("_px"),
                      F.col(py).cast("double").alias("_py")).where(
        F.col("_px").isNotNull() & F.col("_py").isNotNull() & ~F.isnan("_px") & ~F.isnan("_py"))
    Fc = facilities.select(F.col(fac_id).alias("_fid"), F.col(fx).cast("double").alias("_fx"),
                           F.col(fy).cast("double").alias("_fy")).where(
        F.col("_fx").isNotNull() & F.col("_fy").isNotNull() & ~F.isnan("_fx") & ~F.isnan("_fy"))
    if k == 1:
        Fc = Fc.groupBy("_fx", "_fy").agg(F.min("_fid").alias("_fid"))
    else:
        # at most k facilities of one location can be among a point's k nearest
        # (ties go to smaller ids), so a location holding many keeps its k smallest
        Fc = top_k_per_group(Fc, ["_fx", "_fy"], k, [], "_fid").drop("group_rank")
    Fc, found = _written(Fc, "facilities", n=F.count(F.lit(1)), x0=F.min("_fx"), x1=F.max("_fx"), y0=F.min("_fy"), y1=F.max("_fy"))
    if not found.get("n"):
        return None
    b0 = float(base_cell or _spacing(found, k)) / 4.0 ** FINER_LEVELS
    base = FINER_LEVELS
    top = max(base, int(math.ceil(math.log(EARTH_SPAN_M / b0, 4.0))) + 1)

    def bucket(c):
        return F.floor(F.col(c) / F.lit(b0)).cast("long")

    def keyed(levels):
        """The facilities with their bucket at each of the levels."""
        return (Fc.withColumn("_bx", bucket("_fx")).withColumn("_by", bucket("_fy"))
                .select("_fid", "_fx", "_fy", "_bx", "_by", F.explode(F.array(*[F.lit(v) for v in levels])).alias("_lv"))
                .select("_lv", _up("_bx", F.col("_lv")).alias("_cx"), _up("_by", F.col("_lv")).alias("_cy"), "_fid", "_fx", "_fy"))

    def counted(rows):
        return rows.groupBy("_lv", "_cx", "_cy").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_fx").alias("_x1"), F.max("_fx").alias("_x2"),
            F.min("_fy").alias("_y1"), F.max("_fy").alias("_y2"))

    # the buckets of the mean spacing, and from them the wider ones; finer ones are counted where a round needs them
    lowest = materialise(counted(keyed([base])), "occupied")
    wider = materialise(
        lowest.select(F.explode(F.sequence(F.lit(base + 1), F.lit(max(top, base + 1)))).alias("_lv"), F.col("_cx").alias("_bx"), F.col("_cy").alias("_by"),
                      "_n", "_x1", "_x2", "_y1", "_y2")
        .select("_lv", _up("_bx", F.col("_lv") - base).alias("_cx"), _up("_by", F.col("_lv") - base).alias("_cy"), "_n", "_x1", "_x2", "_y1", "_y2")
        .groupBy("_lv", "_cx", "_cy").agg(
            F.sum("_n").alias("_n"), F.min("_x1").alias("_x1"), F.max("_x2").alias("_x2"), F.min("_y1").alias("_y1"), F.max("_y2").alias("_y2")), "occupied")
    occupied = lowest.unionByName(wider)

    def around(reach: int, name: str):
        return F.explode(F.array(*[F.lit(i) for i in range(-reach, reach + 1)])).alias(name)

    blocks = (occupied.select("_lv", "_cx", "_cy", "_n", around(1, "_i")).select("*", around(1, "_j"))
              .groupBy("_lv", (F.col("_cx") + F.col("_i")).alias("_cx"), (F.col("_cy") + F.col("_j")).alias("_cy"))
              .agg(F.sum("_n").alias("_n9")).where(F.col("_n9") >= k).drop("_n9"))
    P0 = P.withColumn("_bx", bucket("_px")).withColumn("_by", bucket("_py"))
    box = [F.min("_px").alias("_px1"), F.max("_px").alias("_px2"), F.min("_py").alias("_py1"), F.max("_py").alias("_py2")]

    def at_level(level):
        """The bucket of each point at that level, as a group's key."""
        return [F.lit(level).cast("int").alias("_gl"), _up("_bx", F.lit(level)).alias("_gx"), _up("_by", F.lit(level)).alias("_gy")]

    steps = F.explode(F.sequence(F.lit(base), F.lit(top))).alias("_lv")
    starts = (P0.groupBy(*at_level(base)).agg(*box).select(*_GROUP, *_BOX, steps)
              .withColumn("_cx", _up("_gx", F.col("_lv") - base)).withColumn("_cy", _up("_gy", F.col("_lv") - base))
              .join(blocks, ["_lv", "_cx", "_cy"]).groupBy(*_GROUP, *_BOX).agg(F.min(F.struct("_lv", "_cx", "_cy")).alias("_s")))
    edge = F.lit(b0) * F.pow(F.lit(4.0), F.col("_lv").cast("double"))
    cells = (starts.select(*_GROUP, *_BOX, "_s.*", around(3, "_i")).select("*", around(3, "_j"))
             .withColumn("_cx", F.col("_cx") + F.col("_i")).withColumn("_cy", F.col("_cy") + F.col("_j"))
             .withColumn("_u2", F.lit(8.0 * _SLACK) * edge * edge))
    dense = (F.col("_left") > most_pairs) & (F.col("_lv") > 0)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_lv"))   # levels as bits
    seen_levels = {"dense": F.bit_or(F.when(dense, bit)), "rest": F.bit_or(F.when(~dense, bit))}

    def levels_of(bits) -> list[int]:
        return [v for v in range(top + 1) if (bits or 0) >> v & 1]

    frontier, seen = _written(_pruned(cells.join(occupied, ["_lv", "_cx", "_cy"]), k), "frontier", **seen_levels)
    done, level, ends, used = frontier.where(~dense), base, [base], set(levels_of(seen.get("rest")))
    while seen.get("dense"):
        # the points of the groups that descend, as groups one level down (at the finest, as they are)
        rest, down = frontier.where(dense), 1 if level else 0
        inside = (P0.select(*at_level(level), *[_up(c, F.lit(level - down)).alias(n) for c, n in (("_bx", "_hx"), ("_by", "_hy"))], "_px", "_py")
                  .join(rest.select(*_GROUP).distinct(), _GROUP, "left_semi").groupBy(*_GROUP, "_hx", "_hy").agg(*box))
        inner = F.explode(F.array(*[F.lit(i) for i in range(4)]))
        # its buckets' levels below: stored, or counted from the facilities in them
        under = [v - 1 for v in levels_of(seen["dense"])]
        stored = occupied
        if finer := [v for v in under if v < base]:
            parents = rest.select((F.col("_lv") - 1).alias("_lv"), F.col("_cx").alias("_ux"), F.col("_cy").alias("_uy")).distinct()
            few = keyed(finer).withColumn("_ux", _up("_cx", F.lit(1))).withColumn("_uy", _up("_cy", F.lit(1)))
            few = counted(few.join(parents, ["_lv", "_ux", "_uy"], "left_semi"))
            stored = stored.unionByName(few) if len(finer) < len(under) else few
        below = (rest.select(*_GROUP, "_lv", "_cx", "_cy", "_u2", inner.alias("_i")).select("*", inner.alias("_j"))
                 .select(*_GROUP, "_u2", (F.col("_lv") - 1).alias("_lv"), (F.col("_cx") * 4 + F.col("_i")).alias("_cx"),
                         (F.col("_cy") * 4 + F.col("_j")).alias("_cy"))
                 .join(stored, ["_lv", "_cx", "_cy"]).join(inside, _GROUP)
                 .withColumn("_gl", F.col("_gl") - down).withColumn("_gx", F.col("_hx")).withColumn("_gy", F.col("_hy")))
        frontier, seen = _written(_pruned(below, k), "frontier", **seen_levels)
        used |= set(levels_of(seen.get("rest")))
        done, level = done.unionByName(frontier.where(~dense)), level - down
        ends.append(level)
    offered = done.join(keyed(sorted(used) or [base]), ["_lv", "_cx", "_cy"]).select(*_GROUP, "_u2", "_fid", "_fx", "_fy")
    asked = P0.select("_pid", "_px", "_py", "_bx", "_by")
    if len(ends) > 1:   # points of one bucket of the mean spacing may have ended on several levels
        up = [_up(c, F.lit(base) - F.col("_gl")).alias(n) for c, n in (("_gx", "_ax"), ("_gy", "_ay"))]
        stops = done.select(*up, "_gl").distinct()
        asked = (asked.select("*", *[_up(c, F.lit(base)).alias(n) for c, n in (("_bx", "_ax"), ("_by", "_ay"))]).join(stops, ["_ax", "_ay"])
                 .select("_pid", "_px", "_py", "_gl", _up("_bx", F.col("_gl")).alias("_gx"), _up("_by", F.col("_gl")).alias("_gy")))
    else:
        asked = asked.select("_pid", "_px", "_py", *at_level(base))
    dx, dy = F.col("_px") - F.col("_fx"), F.col("_py") - F.col("_fy")
    pairs = asked.join(offered, _GROUP).withColumn("_d2", dx * dx + dy * dy)
    return pairs.where(F.col("_d2") <= F.col("_u2")).select("_pid", "_fid", "_d2")


def nearest_distance_km(points: DataFrame, facilities: DataFrame, *, point_id: str = "hex_id",
                        px: str = "x", py: str = "y", fx: str = "x", fy: str = "y",
                        fac_id: str = "id") -> DataFrame:
    """(point_id, nearest_facility_km, nearest_facility_id) for every point with a facility."""
    nn = nearest(points, facilities, k=1, point_id=point_id, px=px, py=py, fac_id=fac_id, fx=fx, fy=fy)
    return nn.select(point_id, (F.col("distance_m") / F.lit(1000.0)).alias("nearest_facility_km"),
                     F.col("facility_id").alias("nearest_facility_id"))
