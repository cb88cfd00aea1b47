"""The analysis stages (grid, exposure, accessibility, priority) and the
whole pipeline, each a function from DataFrames to DataFrames.

Stage functions add their columns to the grid and keep its row count;
hexagons with population 0 keep NULL distance/scores.  Nothing is
updated in place: each stage is a keyed left join onto the grid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.functions import geo, hexgrid, scoring
from hexaccess.operators import grid as grid_ops
from hexaccess.operators.nearest import nearest_distance_km
from hexaccess.operators.raster import raster_align, raster_cell_xy, raster_valid, reproject_xy
from hexaccess.operators.stats import exact_percentiles, minmax_scalars
from hexaccess.params import Params
from hexaccess.session import materialise
from hexaccess.sources import derived
from hexaccess.sources.raster import Raster, RasterMeta, cell_of_x, cell_of_y


@dataclass
class Inputs:
    admin: DataFrame          # admin_id, GID_0, NAME_0, GID_3, NAME_3, ring (lon/lat)
    facilities: DataFrame     # id, name, amenity, x, y (analysis CRS)
    population: Raster
    flood: Raster


def load_inputs(spark: SparkSession, sf_dir: str, p: Params = Params()) -> Inputs:
    return Inputs(
        admin=derived.admin_lonlat(spark, sf_dir, p),
        facilities=derived.facilities(spark, sf_dir, p),
        population=derived.pop_raster(spark, sf_dir, p),
        flood=derived.flood_raster(spark, sf_dir, p),
    )


def load_inputs_from(spark: SparkSession, admin: str, facilities: str, population: str, flood: str,
                     p: Params = Params()) -> Inputs:
    """Inputs from stored tables: admin units (admin_id, ring or rings in lon/lat, attributes),
    facilities (id, name, amenity and lon, lat or x, y in the analysis CRS; or GeoJSON by its
    ``.json``/``.geojson`` name), and two rasters written with their headers."""
    from hexaccess.sources.raster import read_raster
    from hexaccess.sources.tables import geojson_features
    if facilities.rstrip("/").endswith(("json", "geojson")):
        f = geojson_features(spark, facilities)
    else:
        f = spark.read.parquet(facilities)
    if "x" not in f.columns:
        f = geo.with_utm(f, "lon", "lat", "x", "y", p.utm_zone, p.south_hemisphere)
    return Inputs(spark.read.parquet(admin), f.select("id", "name", "amenity", "x", "y"),
                  read_raster(spark, population), read_raster(spark, flood))


def build_grid(admin: DataFrame, p: Params = Params()) -> DataFrame:
    """Hexagons whose centre is inside any admin unit (a ring, or rings with holes), with geometry."""
    return grid_ops.hex_grid(admin, p.resolution, p, ring_col="rings" if "rings" in admin.columns else "ring")


def exposure_cells(pop: Raster, flood: Raster, p: Params = Params()) -> DataFrame:
    """Population cells with the aligned flood depth and their hexagon id.

    Only flooded flood cells (depth > 0) take part in the join: dry and
    missing cells both mean "not exposed", so the filter is pushed into
    the flood scan and the join's build side shrinks to the wet area.
    """
    cells = raster_align(pop, flood, name="depth", fill=0.0, only_where=F.col("value") > 0)
    cells = cells.select("row", "col", "value", "depth", "x", "y")
    cells = to_analysis_crs(cells, pop.meta.crs, p)
    return hexgrid.with_hex_assign(cells, "_ux", "_uy", p.resolution).select(
        "row", "col", "value", "depth", "hex_id")


def to_analysis_crs(df: DataFrame, crs: str, p: Params, x: str = "x", y: str = "y") -> DataFrame:
    """Add ``_ux``/``_uy``: the x/y columns transformed into the analysis CRS."""
    if crs == p.analysis_crs:
        return df.withColumn("_ux", F.col(x)).withColumn("_uy", F.col(y))
    if crs == "EPSG:4326":
        return geo.with_utm(df, x, y, "_ux", "_uy", p.utm_zone, p.south_hemisphere)
    u = reproject_xy(F.col(x), F.col(y), crs, p.analysis_crs)
    return df.withColumn("_ux", u["x"]).withColumn("_uy", u["y"])


def exposed_sums(cells: DataFrame, pop: RasterMeta, flood: Raster, p: Params = Params()) -> DataFrame:
    """(q, r, population, population_exposed) of population cells (row, col, value).

    Each valid cell gets its hexagon and the flood cell that holds its centre (through
    the CRS of each), population is summed per (hexagon, flood cell) -- a
    map-side combine -- and only those sums meet the flooded cells.  Streams take
    the same way, but for the join, which comes first there (a stream has one aggregation).
    """
    c = raster_cell_xy(Raster(cells, pop)).select("value", "x", "y")
    o = reproject_xy(F.col("x"), F.col("y"), pop.crs, flood.meta.crs)
    c = c.withColumn("_o", o).withColumn("_frow", cell_of_y(F.col("_o.y"), flood.meta)) \
         .withColumn("_fcol", cell_of_x(F.col("_o.x"), flood.meta)).drop("_o")
    c = hexgrid.with_hex_axial(to_analysis_crs(c, pop.crs, p).select("value", "_frow", "_fcol", "_ux", "_uy"),
                               "_ux", "_uy", p.resolution)
    wet = raster_valid(flood).where(F.col("value") > 0).select(
        F.col("row").alias("_frow"), F.col("col").alias("_fcol"), F.col("value").alias("depth"))
    if not cells.isStreaming:
        c = c.groupBy("q", "r", "_frow", "_fcol").agg(F.sum("value").alias("value"))
    j = c.join(wet, ["_frow", "_fcol"], "left").withColumn("depth", F.coalesce("depth", F.lit(0.0)))
    return j.groupBy("q", "r").agg(
        F.sum("value").alias("population"),
        F.sum(scoring.flood_mask(F.col("depth"), F.col("value"))).alias("population_exposed"))


def zonal_exposure(pop: Raster, flood: Raster, p: Params = Params()) -> DataFrame:
    """(hex_id, population, population_exposed); hexagon ids are written after the sums."""
    sums = exposed_sums(pop.cells, pop.meta, flood, p)
    return sums.select(hexgrid.hex_id(F.lit(p.resolution), F.col("q"), F.col("r")).alias("hex_id"),
                       "population", "population_exposed")


def exposure(grid: DataFrame, pop: Raster, flood: Raster, p: Params = Params()) -> DataFrame:
    """Population, exposed population and exposure percent per hexagon."""
    per_hex = zonal_exposure(pop, flood, p)
    g = grid.drop("population", "population_exposed", "exposure_pct").join(per_hex, "hex_id", "left")
    g = g.withColumn("population", F.coalesce(F.col("population"), F.lit(0.0))) \
         .withColumn("population_exposed", F.coalesce(F.col("population_exposed"), F.lit(0.0)))
    return g.withColumn("exposure_pct", scoring.exposure_pct(F.col("population_exposed"), F.col("population")))


def accessibility(grid: DataFrame, facilities: DataFrame, p: Params = Params(),
                  materialise_input: bool = True, network: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Distance from each populated hexagon centroid to the nearest
    facility, its class and score: in a straight line, or along ``network``
    (edges, nodes).  The searches read the points several times and run
    jobs (written rounds) while the frame is being built, so the input grid
    is materialised first unless the caller already did."""
    if materialise_input:
        grid = materialise(grid)
    populated = grid.where(F.col("population") > 0).select(
        "hex_id", F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y"))
    if network is None:
        nn = nearest_distance_km(populated, facilities).drop("nearest_facility_id")
    else:
        from hexaccess.operators.graph import network_access
        nn = network_access(populated, facilities, *network)
    g = grid.drop("nearest_facility_km", "accessibility_class", "accessibility_score").join(nn, "hex_id", "left")
    d = F.col("nearest_facility_km")
    return (g.withColumn("accessibility_class", scoring.access_class(d, p.threshold_km, p.moderate_km))
             .withColumn("accessibility_score", scoring.access_score(d, p.threshold_km, p.moderate_km)))


def road_network(segments: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) of road lines (id, line in lon/lat), as written tables, for ``accessibility``'s ``network``."""
    from hexaccess.operators.graph import road_edges, road_nodes
    at = dict(zone=p.utm_zone, south=p.south_hemisphere)
    return materialise(road_edges(segments, **at), "road_edges"), materialise(road_nodes(segments, **at), "road_nodes")


def priority_thresholds(scored: DataFrame, p: Params = Params()) -> tuple[float | None, float | None]:
    """(high, medium) thresholds: exact percentiles 100 - top and 50 of the
    populated hexagons' priority scores."""
    from hexaccess.fixed import PRIORITY_MID_PERCENTILE
    hi, mid = exact_percentiles(scored.where(F.col("population") > 0), "priority_score",
                                [(100.0 - p.top_percentile) / 100.0, PRIORITY_MID_PERCENTILE / 100.0])
    return hi, mid


def priority_scores(grid: DataFrame, p: Params = Params()) -> DataFrame:
    """Exposure score (min-max over populated hexagons) and weighted priority score."""
    populated = F.col("population") > 0
    lo, hi = minmax_scalars(grid.where(populated), "population_exposed")
    es = scoring.minmax_scale(F.col("population_exposed"), lo, hi)
    g = grid.drop("exposure_score", "priority_score", "priority_class")
    g = g.withColumn("exposure_score", F.when(populated, es))
    return g.withColumn("priority_score", F.when(populated, scoring.priority_score(
        F.col("exposure_score"), F.col("accessibility_score"), p.exposure_weight, p.accessibility_weight)))


def priority(grid: DataFrame, p: Params = Params(), materialise_input: bool = True) -> DataFrame:
    """C4: priority score and class.  The grid is materialised first (to the
    session's shared checkpoint folder) because the exact percentile passes
    scan it several times."""
    if materialise_input:
        grid = materialise(grid)
    scored = priority_scores(grid, p)
    # the passes read one written column, not the scores' expressions and the two subqueries behind them again
    scores = materialise(scored.where(F.col("population") > 0).select("population", "priority_score"), "scores")
    t_hi, t_mid = priority_thresholds(scores, p)
    if t_hi is None:
        return scored.withColumn("priority_class", F.lit(None).cast("string"))
    cls = scoring.priority_class(F.col("priority_score"), F.lit(t_hi), F.lit(t_mid))
    return scored.withColumn("priority_class", F.when(F.col("population") > 0, cls))


def analysis_grid(inputs: Inputs, p: Params = Params(), network: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Grid -> exposure -> accessibility -> priority (the fixed stage order)."""
    g = build_grid(inputs.admin, p)
    g = materialise(exposure(g, inputs.population, inputs.flood, p), "exposure")
    g = materialise(accessibility(g, inputs.facilities, p, materialise_input=False, network=network), "accessibility")
    return priority(g, p, materialise_input=False)


def hex_admin_units(grid: DataFrame, admin: DataFrame, p: Params = Params(), bucket_deg: float = 0.1,
                    ring: str = "ring") -> DataFrame:
    """(hex_id, admin_id) -- the admin unit whose lon/lat polygon (a ring, or
    rings with holes; one row per part) holds each hexagon centre."""
    from hexaccess.operators.zonal import point_in_zone
    pts = geo.with_lonlat(grid.select("hex_id", F.col("centroid.x").alias("_cx"), F.col("centroid.y").alias("_cy")),
                          "_cx", "_cy", "_lon", "_lat", p.utm_zone, p.south_hemisphere)
    zones = admin.select(F.col("admin_id").alias("_zone"), ring)
    hit = point_in_zone(pts, zones, bucket_deg, "_lon", "_lat", zone_id="_zone", ring=ring)
    return hit.select("hex_id", F.col("_zone").alias("admin_id"))


def admin_rollup(grid: DataFrame, admin: DataFrame, p: Params = Params(),
                 levels: tuple[str, ...] = ("NAME_0", "NAME_3")) -> DataFrame:
    """Hexagon results rolled up to admin units with subtotals."""
    from hexaccess.operators import summaries
    ring = "rings" if "rings" in admin.columns else "ring"
    tagged = grid.join(hex_admin_units(grid, admin, p, ring=ring), "hex_id").join(
        admin.select("admin_id", *levels).distinct(), "admin_id")
    return summaries.admin_rollup(tagged, levels)


def pipeline_from_inputs(inputs: Inputs, p: Params = Params(), network: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """C9 over already-loaded inputs: every output of a run."""
    from hexaccess.operators import summaries
    g = analysis_grid(inputs, p, network)
    return {
        "grid": g,
        "admin": inputs.admin,
        "facilities": inputs.facilities,
        "run_summary": summaries.run_summary(g),
        "class_counts": summaries.class_counts(g),
        "admin_rollup": admin_rollup(g, inputs.admin, p),
    }


def pipeline(spark: SparkSession, sf_dir: str, p: Params = Params()) -> dict[str, DataFrame]:
    """Every output of a run as DataFrames (stage tables are written as
    the run goes; summaries stay lazy)."""
    return pipeline_from_inputs(load_inputs(spark, sf_dir, p), p)


def top_priority(grid: DataFrame) -> DataFrame:
    """L4: the high-priority hexagons."""
    from hexaccess.fixed import PRIORITY_CLASSES
    return grid.where(F.col("priority_class") == PRIORITY_CLASSES[0])


def to_lonlat_grid(grid: DataFrame, p: Params = Params()) -> DataFrame:
    """Grid geometry and centroid back in lon/lat (output CRS)."""
    z, s = p.utm_zone, p.south_hemisphere
    return (grid.withColumn("geometry", geo.ring_to_lonlat(F.col("geometry"), z, s))
                .withColumn("centroid", geo.to_lonlat(F.col("centroid.x"), F.col("centroid.y"), z, s)))
