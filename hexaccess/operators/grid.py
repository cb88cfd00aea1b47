"""Hexagon grid construction: polyfill of study polygons and the grid table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess.functions import geo, hexgrid, polygon
from hexaccess.operators.edges import cross_at, inside_runs, polygon_edges, span
from hexaccess.operators.zonal import centres_within, columns_of, rows_of, turns_between
from hexaccess.params import Params

GRID_COLUMNS = [
    "hex_id", "resolution", "geometry", "centroid", "area_km2", "population",
    "population_exposed", "exposure_pct", "nearest_facility_km", "accessibility_class",
    "accessibility_score", "exposure_score", "priority_score", "priority_class",
]


def _projected_pieces(edges: DataFrame, zone_col: str, p: Params, step_deg: float) -> DataFrame:
    """Edges cut into pieces of at most ``step_deg`` and projected: (zone_col, _part, ux, uy, vx, vy)."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    n = F.greatest(F.lit(1), F.ceil(F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)) / F.lit(step_deg)).cast("int"))
    pieces = edges.withColumn("_n", n).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))

    def at(j, a, b):
        # the edge's own end points are kept to the last bit, so neighbouring pieces meet
        return F.when(j == F.col("_n"), b).otherwise(a + (b - a) * j.cast("double") / F.col("_n").cast("double"))

    j = F.col("_j")
    pieces = pieces.select(zone_col, "_part", at(j, ax, bx).alias("_ulon"), at(j, ay, by).alias("_ulat"),
                           at(j + 1, ax, bx).alias("_vlon"), at(j + 1, ay, by).alias("_vlat"))
    zone, south = p.utm_zone, p.south_hemisphere
    pieces = geo.with_utm(pieces, "_ulon", "_ulat", "ux", "uy", zone, south)
    return geo.with_utm(pieces, "_vlon", "_vlat", "vx", "vy", zone, south).select(zone_col, "_part", "ux", "uy", "vx", "vy")


def hex_polyfill(zones: DataFrame, res: int, p: Params = Params(), zone_col: str = "admin_id",
                 ring_col: str = "ring", margin_m: float = 10.0, step_deg: float = 0.01) -> DataFrame:
    """Hexagons whose centre lies inside each zone (rings in lon/lat, tested in
    lon/lat; ``ring_col`` holds a ring, or the rings of a polygon with holes;
    a zone may be several rows).  Returns ``(zone_col, q, r, hex_id)``.

    The zones become edges.  Each edge, cut into short pieces and projected,
    gives its crossings with the rows of hexagon centres (constant y in the
    analysis CRS); between a row's sorted crossings hexagons are inside by
    parity and are emitted without a test.  Only hexagons within ``margin_m``
    of a crossing -- where the projected pieces may differ from the true lon/lat
    edge by millimetres -- get the exact lon/lat test: a bucket of about a hexagon's
    size has its centre's side, which the edges in that bucket alone turn over.
    Cost is O(edges x rows they span + output), and shuffles carry crossings,
    edges and hexagons, never rings.
    """
    s = hexgrid.hex_edge_m(res)
    w, h = s * hexgrid.SQRT3, 1.5 * s
    edges = polygon_edges(zones, zone_col, ring_col)
    pieces = _projected_pieces(edges, zone_col, p, step_deg)
    uy, vy = F.col("uy"), F.col("vy")
    rows = pieces.select("*", F.explode(span(F.ceil(F.least(uy, vy) / h) - 1, F.floor(F.greatest(uy, vy) / h) + 1)).alias("r"))
    y = F.lit(h) * F.col("r").cast("double")
    crossings = rows.select(zone_col, "_part", "r", cross_at(y, F.col("ux"), uy, F.col("vx"), vy).alias("_x")).where("_x IS NOT NULL")
    half = F.col("r").cast("double") / F.lit(2.0)
    first = lambda x: F.ceil(x / F.lit(w) - half)  # noqa: E731  first hexagon of the row at or after x
    last = lambda x: F.floor(x / F.lit(w) - half)
    sure = (inside_runs(crossings, [zone_col, "_part", "r"], "_x")
            .select(zone_col, "r", F.explode(span(first(F.col("lo") + margin_m), last(F.col("hi") - margin_m))).alias("q")))
    near = (crossings.select(zone_col, "_part", "r", F.explode(span(first(F.col("_x") - margin_m), last(F.col("_x") + margin_m))).alias("q"))
            .distinct())
    c = hexgrid.hex_center(F.col("q"), F.col("r"), res)
    near = near.select(zone_col, "_part", "q", "r", c["x"].alias("_cx"), c["y"].alias("_cy"))
    near = geo.with_lonlat(near, "_cx", "_cy", "_lon", "_lat", p.utm_zone, p.south_hemisphere)
    b = h / 110_000.0   # buckets of about a row's height
    near = near.withColumn("_gx", F.floor(F.col("_lon") / b)).withColumn("_gy", F.floor(F.col("_lat") / b))
    key = [zone_col, "_part", "_gx", "_gy"]
    lines = rows_of(edges, b)
    touched = columns_of(lines, b).select(*key, F.struct("ax", "ay", "bx", "by").alias("_e"))
    centre = lambda c: (F.col(c).cast("double") + 0.5) * b
    turns = F.coalesce(turns_between(F.col("_lon"), F.col("_lat"), centre("_gx"), centre("_gy"), F.col("_e")), F.lit(0))
    exact = (near.join(centres_within(lines, b, zone_col), key, "left").join(touched, key, "left").groupBy(zone_col, "_part", "q", "r")
             .agg(F.sum(turns).alias("_n"), F.first(F.coalesce("_in", F.lit(False))).alias("_in"))
             .where(F.col("_in") != (F.col("_n") % 2 == 1)))
    out = sure.select(zone_col, "q", "r").unionByName(exact.select(zone_col, "q", "r")).distinct()
    return out.select(zone_col, F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"),
                      hexgrid.hex_id(F.lit(res), F.col("q"), F.col("r")).alias("hex_id"))


def hex_polyfill_union(zones: DataFrame, res: int, p: Params = Params(), zone_col: str = "admin_id",
                       ring_col: str = "ring") -> DataFrame:
    """Hexagons inside *any* zone part: polyfill of the union, no dissolve needed."""
    return hex_polyfill(zones, res, p, zone_col, ring_col).select("q", "r").distinct().select(
        hexgrid.hex_id(F.lit(res), F.col("q"), F.col("r")).alias("hex_id"), "q", "r")


def hex_geometry(hexes: DataFrame, res: int) -> DataFrame:
    """Add ``geometry`` (closed ring), ``centroid`` and ``area_km2`` to (hex_id, q, r).
    A regular hexagon's centroid is its centre, so it is taken exactly from
    the axial coordinates rather than re-derived from the rounded vertices."""
    ring = hexgrid.hex_boundary(F.col("q"), F.col("r"), res)
    return (
        hexes.withColumn("geometry", ring)
        .withColumn("centroid", hexgrid.hex_center(F.col("q"), F.col("r"), res))
        .withColumn("area_km2", polygon.polygon_area(F.col("geometry")) / F.lit(1.0e6))
    )


def hex_grid(admin: DataFrame, res: int, p: Params = Params(), zone_col: str = "admin_id",
             ring_col: str = "ring") -> DataFrame:
    """The grid table: one row per hexagon covering the study area, analysis
    columns at their defaults (0 for population figures, NULL for scores)."""
    hexes = hex_polyfill_union(admin, res, p, zone_col, ring_col)
    g = hex_geometry(hexes, res).withColumn("resolution", F.lit(res))
    return g.select(
        "hex_id", "resolution", "geometry", "centroid", "area_km2",
        F.lit(0.0).alias("population"), F.lit(0.0).alias("population_exposed"),
        F.lit(0.0).alias("exposure_pct"), F.lit(None).cast("double").alias("nearest_facility_km"),
        F.lit(None).cast("string").alias("accessibility_class"),
        F.lit(None).cast("double").alias("accessibility_score"),
        F.lit(None).cast("double").alias("exposure_score"),
        F.lit(None).cast("double").alias("priority_score"),
        F.lit(None).cast("string").alias("priority_class"),
    )


def hex_parent_rollup(grid: DataFrame, res: int) -> DataFrame:
    """Roll hexagon results up one level: each hexagon goes to the coarser
    hexagon containing its centre; sums add, percentages are recomputed."""
    c = F.col("centroid")
    pa = hexgrid.parent_res_axial(c["x"], c["y"], res)
    parent = hexgrid.hex_id(F.lit(res - 1), pa["q"], pa["r"])
    return (
        grid.select(parent.alias("parent_id"), "population", "population_exposed")
        .groupBy("parent_id")
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("population").alias("population"),
            F.sum("population_exposed").alias("population_exposed"),
        )
    )
