"""Analysis inputs derived from the given tables by fixed arithmetic.

The driver's tables carry no coordinates, so every spatial input is a
deterministic function of a dense integer key.  The same rules are
written in the DuckDB oracle (``sqlcheck``), so both engines build
identical inputs.  Everything scales with the source tables: the
population raster has one cell per order, the flood raster one cell per
customer, one facility per supplier, one lake record per part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.functions import geo
from hexaccess.params import Params
from hexaccess.sources.raster import Raster, RasterMeta
from hexaccess.sources.tables import spread

# Low-discrepancy multipliers spreading keys over the box.
KEY_MULT_X = 0.6180339887498949
KEY_MULT_Y = 0.7548776662466927
FLOOD_SHARE_DRY = 0.7       # frac <= 0.7 is dry, so about 30 % of cells flood
FLOOD_DEPTH_MIN = 0.5
FLOOD_DEPTH_SPAN = 2.5
POP_DIVISOR = 10000.0
#: Corners as shares of a unit's box (from its south-west corner): parts, rings (the first outer), corners.
ADMIN_SHAPES = {
    "box": [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]],
    "hole": [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(0.35, 0.35), (0.35, 0.65), (0.65, 0.65), (0.65, 0.35)]]],
    "notch": [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.6, 1.0), (0.5, 0.4), (0.4, 1.0), (0.0, 1.0)]]],
    "parts": [[[(0.0, 0.0), (0.45, 0.0), (0.45, 1.0), (0.0, 1.0)]], [[(0.55, 0.0), (1.0, 0.0), (1.0, 1.0), (0.55, 1.0)]]],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frac(c: Column) -> Column:
    return c - F.floor(c)


def key_lon(k, p: Params) -> Column:
    kc = (F.col(k) if isinstance(k, str) else k).cast("double")
    return F.lit(p.west) + frac(kc * F.lit(KEY_MULT_X)) * F.lit(p.east - p.west)


def key_lat(k, p: Params) -> Column:
    kc = (F.col(k) if isinstance(k, str) else k).cast("double")
    return F.lit(p.south) + frac(kc * F.lit(KEY_MULT_Y)) * F.lit(p.north - p.south)


def _square_grid_meta(n: int, p: Params, nodata=None) -> RasterMeta:
    w = int(math.ceil(math.sqrt(n))) if n > 0 else 1
    h = int(math.ceil(n / w)) if n > 0 else 1
    return RasterMeta.from_bounds(p.west, p.south, p.east, p.north, w, h, "EPSG:4326", nodata)


def pop_raster(spark: SparkSession, sf_dir: str, p: Params = Params()) -> Raster:
    """Population counts: one cell per order, row-major on a near-square grid."""
    orders = table(spark, sf_dir, "orders")
    meta = _square_grid_meta(orders.count(), p)
    w = meta.n_cols
    cells = orders.select(
        F.floor(F.col("o_orderkey") / F.lit(w)).cast("long").alias("row"),
        (F.col("o_orderkey") % F.lit(w)).cast("long").alias("col"),
        F.greatest(F.col("o_totalprice") / F.lit(POP_DIVISOR), F.lit(0.0)).alias("value"),
    )
    return Raster(cells, meta)


def flood_raster(spark: SparkSession, sf_dir: str, p: Params = Params()) -> Raster:
    """Flood depth: one cell per customer on its own, coarser grid; 0 = dry/nodata."""
    cust = table(spark, sf_dir, "customer")
    meta = _square_grid_meta(cust.count(), p, nodata=0.0)
    w = meta.n_cols
    k = F.col("c_custkey").cast("double")
    depth = F.when(frac(k * F.lit(KEY_MULT_X)) <= F.lit(FLOOD_SHARE_DRY), F.lit(0.0)).otherwise(
        F.lit(FLOOD_DEPTH_MIN) + F.lit(FLOOD_DEPTH_SPAN) * frac(k * F.lit(KEY_MULT_Y)))
    cells = cust.select(
        F.floor(F.col("c_custkey") / F.lit(w)).cast("long").alias("row"),
        (F.col("c_custkey") % F.lit(w)).cast("long").alias("col"),
        depth.alias("value"),
    )
    return Raster(cells, meta)


def facilities_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    """Health facilities: (id, name, amenity, lon, lat), one per supplier."""
    sup = table(spark, sf_dir, "supplier")
    return sup.select(
        F.col("s_suppkey").cast("long").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("clinic")).otherwise(F.lit("hospital")).alias("amenity"),
        key_lon("s_suppkey", p).alias("lon"),
        key_lat("s_suppkey", p).alias("lat"),
    )


def facilities(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    """Facilities in the analysis CRS: (id, name, amenity, x, y)."""
    f = facilities_lonlat(spark, sf_dir, p)
    return geo.with_utm(f, "lon", "lat", "x", "y", p.utm_zone, p.south_hemisphere).select(
        "id", "name", "amenity", "x", "y")


def admin_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params(), tiles: int = 5) -> DataFrame:
    """Admin units: a tiles x tiles tiling of the study box, one per nation."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    dx = (p.east - p.west) / tiles
    dy = (p.north - p.south) / tiles
    k = F.col("n_nationkey").cast("long")
    c = (k % tiles).cast("double")
    r = F.floor(k / F.lit(tiles)).cast("double")
    west = F.lit(p.west) + c * F.lit(dx)
    east = F.lit(p.west) + (c + F.lit(1.0)) * F.lit(dx)
    north = F.lit(p.north) - r * F.lit(dy)
    south = F.lit(p.north) - (r + F.lit(1.0)) * F.lit(dy)
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            F.col("n_nationkey").cast("long").alias("admin_id"),
            F.lit(p.country_code).alias("GID_0"),
            F.col("r_name").alias("NAME_0"),
            F.concat(F.lit(p.country_code + "."), F.col("n_nationkey").cast("string")).alias("GID_3"),
            F.col("n_name").alias("NAME_3"),
            geo.box_ring(west, south, east, north).alias("ring"),
        )
    )


def admin_shapes_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params(), tiles: int = 5) -> DataFrame:
    """Admin units as real boundaries are: (admin_id, part_id, rings), by key % 4 a
    plain box, a box with a hole, a concave ring, or a unit of two parts."""
    k = F.col("admin_id")
    west, south = F.get(F.col("ring"), 0)["x"], F.get(F.col("ring"), 0)["y"]
    dx, dy = F.lit((p.east - p.west) / tiles), F.lit((p.north - p.south) / tiles)

    def ring(*corners):
        pts = [geo.point(west + F.lit(fx) * dx, south + F.lit(fy) * dy) for fx, fy in (*corners, corners[0])]
        return F.array(*pts)

    parts = F.array
    shapes = {name: [[ring(*corners) for corners in rings] for rings in poly] for name, poly in ADMIN_SHAPES.items()}
    as_parts = lambda name: parts(*[F.array(*rings) for rings in shapes[name]])
    chosen = (F.when(k % 4 == 0, as_parts("box")).when(k % 4 == 1, as_parts("hole"))
              .when(k % 4 == 2, as_parts("notch")).otherwise(as_parts("parts")))
    return admin_lonlat(spark, sf_dir, p, tiles).select(
        "admin_id", "NAME_0", "NAME_3", F.posexplode(chosen).alias("part_id", "rings"))


def places_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params(), half: float = 1e-4) -> DataFrame:
    """Lake records: one per part, a tiny bbox around the key's point,
    themed by the part's type."""
    part = table(spark, sf_dir, "part")
    lon, lat = key_lon("p_partkey", p), key_lat("p_partkey", p)
    return part.select(
        F.concat(F.lit("place_"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_partkey").cast("long").alias("key"),
        F.col("p_name").alias("name"),
        F.struct(
            (lon - F.lit(half)).alias("xmin"), (lon + F.lit(half)).alias("xmax"),
            (lat - F.lit(half)).alias("ymin"), (lat + F.lit(half)).alias("ymax"),
        ).alias("bbox"),
        geo.point(lon, lat).alias("geometry"),
        F.lower(F.col("p_type")).alias("theme"),
        F.lit("place").alias("type"),
    )


def lake_shapes_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params(), half: float = 1e-4) -> DataFrame:
    """Lake records with WKT geometry: per part a small square building and a short road."""
    b = spread(places_lonlat(spark, sf_dir, p, half).select("id", "bbox"))
    box = geo.box_ring(F.col("bbox.xmin"), F.col("bbox.ymin"), F.col("bbox.xmax"), F.col("bbox.ymax"))
    road = F.format_string("LINESTRING(%s)", F.concat_ws(", ", *[
        F.concat_ws(" ", F.col(f"bbox.x{m}").cast("string"), F.col(f"bbox.y{m}").cast("string")) for m in ("min", "max")]))
    building = b.select("id", "bbox", geo.ring_to_wkt(box).alias("geometry"), F.lit("buildings").alias("theme"), F.lit("building").alias("type"))
    return building.unionByName(b.select("id", "bbox", road.alias("geometry"), F.lit("transportation").alias("theme"), F.lit("segment").alias("type")))


def pop_points(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    """Weighted points (one per customer) in lon/lat: (pid, lon, lat, weight)."""
    cust = table(spark, sf_dir, "customer")
    return cust.select(
        F.col("c_custkey").cast("long").alias("pid"),
        key_lon("c_custkey", p).alias("lon"),
        key_lat("c_custkey", p).alias("lat"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("weight"),
    )


def road_segments_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params(), source: str = "supplier",
                         key: str = "s_suppkey", shift: float = 0.0) -> DataFrame:
    """Road segments: the point of key k joined to that of key k + 1 (a chain), keys moved by ``shift``."""
    keys = spread(table(spark, sf_dir, source).select(F.col(key).cast("long").alias("k")))
    at = lambda k: geo.point(key_lon(k, p), key_lat(k, p))
    k = F.col("k") if shift == 0 else F.col("k") + F.lit(shift)
    return keys.select(F.col("k").alias("id"), F.array(at(k), at(k + 1)).alias("line"))


def far_road_segments_lonlat(spark: SparkSession, sf_dir: str, p: Params = Params()) -> DataFrame:
    """Road segments whose nodes are no facilities: a chain over customers, half a key further."""
    return road_segments_lonlat(spark, sf_dir, p, "customer", "c_custkey", 0.5)
