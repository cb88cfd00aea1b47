"""Polygons as edge tables: what the grid and the point-in-zone joins work on.

A polygon is a row with a ring (array of points) or an array of rings (outer
ring and holes); a zone of several parts is several rows.  Work is keyed by
edge, grid line and bucket, so no join or shuffle carries a ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from hexaccess.session import materialise


def as_rings(df: DataFrame, col: str) -> Column:
    """The column as an array of rings, whether it holds rings or a single ring."""
    return F.col(col) if isinstance(df.schema[col].dataType.elementType, ArrayType) else F.array(F.col(col))


def polygon_edges(zones: DataFrame, zone_col: str, ring_col: str) -> DataFrame:
    """(zone_col, _part, ax, ay, bx, by): one row per edge of every ring; _part tells rows of
    ``zones`` apart.  A written table, as the callers read it more than once."""
    parts = zones.select(F.col(zone_col), as_rings(zones, ring_col).alias("_rings")).withColumn(
        "_part", F.monotonically_increasing_id())   # before the explode: one number for all rings of a row
    rings = parts.select(zone_col, "_part", F.explode("_rings").alias("_r"))
    edges = rings.select(zone_col, "_part", F.explode(F.arrays_zip(
        F.slice(F.col("_r"), F.lit(1), F.greatest(F.size("_r") - 1, F.lit(0))).alias("a"),
        F.slice(F.col("_r"), F.lit(2), F.greatest(F.size("_r") - 1, F.lit(0))).alias("b"))).alias("_e"))
    return materialise(edges.select(zone_col, "_part", F.col("_e.a.x").alias("ax"), F.col("_e.a.y").alias("ay"),
                                    F.col("_e.b.x").alias("bx"), F.col("_e.b.y").alias("by")), "edges")


def crosses(y, ay, by) -> Column:
    """Half-open straddle rule: whether an edge from ay to by crosses the line at y."""
    return (ay > y) != (by > y)


def cross_at(y, ax, ay, bx, by) -> Column:
    """x of the crossing (NULL if there is none)."""
    return (bx - ax) * (y - ay) / F.when(crosses(y, ay, by), by - ay) + ax


def span(lo: Column, hi: Column) -> Column:
    """The whole numbers from lo to hi; NULL if there are none (a sequence would count down)."""
    lo, hi = lo.cast("long"), hi.cast("long")
    return F.when(lo <= hi, F.sequence(lo, hi))


def inside_runs(crossings: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, lo, hi): between the crossings of a line with a polygon, the runs that are inside (lo <= x < hi)."""
    xs = crossings.groupBy(*keys).agg(F.array_sort(F.collect_list(x)).alias("_xs"))
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size("_xs") / 2).cast("int") - 1),
                       lambda k: F.struct(F.get(F.col("_xs"), 2 * k).alias("lo"), F.get(F.col("_xs"), 2 * k + 1).alias("hi")))
    return xs.select(*keys, F.explode(F.when(F.size("_xs") >= 2, runs)).alias("_run")).select(*keys, "_run.lo", "_run.hi")
