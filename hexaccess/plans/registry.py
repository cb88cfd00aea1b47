"""Named queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or tables Spark derives from them),
runs over all of their rows, and returns plain columns (no geometry
structs) rounded to stable precision, so results can be compared
across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.params import Params
from hexaccess.plans import jobs

P = Params()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r(c, n: int) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# ----------------------------------------------------------------------------- composite jobs

@query("hex_grid")
def q_hex_grid(spark, sf):
    inp = jobs.load_inputs(spark, sf, P)
    g = jobs.build_grid(inp.admin, P)
    return g.select("hex_id", "resolution", r(F.col("centroid.x"), 3).alias("cx"),
                    r(F.col("centroid.y"), 3).alias("cy"), r("area_km2", 6).alias("area_km2"),
                    F.size("geometry").alias("n_vertices"))


@query("exposure")
def q_exposure(spark, sf):
    inp = jobs.load_inputs(spark, sf, P)
    g = jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P)
    return g.select("hex_id", r("population", 6).alias("population"),
                    r("population_exposed", 6).alias("population_exposed"),
                    r("exposure_pct", 6).alias("exposure_pct"))


def _access_grid(spark, sf) -> DataFrame:
    inp = jobs.load_inputs(spark, sf, P)
    g = jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P)
    return jobs.accessibility(g, inp.facilities, P)


@query("accessibility")
def q_accessibility(spark, sf):
    g = _access_grid(spark, sf)
    return g.select("hex_id", r("nearest_facility_km", 6).alias("nearest_facility_km"),
                    "accessibility_class", r("accessibility_score", 6).alias("accessibility_score"))


def analysis(spark, sf) -> DataFrame:
    return jobs.analysis_grid(jobs.load_inputs(spark, sf, P), P)


@query("priority")
def q_priority(spark, sf):
    g = analysis(spark, sf)
    return g.select("hex_id", r("exposure_score", 6).alias("exposure_score"),
                    r("priority_score", 6).alias("priority_score"), "priority_class")


def grid_attributes(g: DataFrame) -> DataFrame:
    return g.select(
        "hex_id", "resolution", r(F.col("centroid.x"), 3).alias("cx"), r(F.col("centroid.y"), 3).alias("cy"),
        r("population", 6).alias("population"), r("population_exposed", 6).alias("population_exposed"),
        r("exposure_pct", 6).alias("exposure_pct"), r("nearest_facility_km", 6).alias("nearest_facility_km"),
        "accessibility_class", r("accessibility_score", 6).alias("accessibility_score"),
        r("exposure_score", 6).alias("exposure_score"), r("priority_score", 6).alias("priority_score"),
        "priority_class")


@query("hazard_pipeline")
def q_pipeline(spark, sf):
    return grid_attributes(analysis(spark, sf))


@query("nearest_distance")
def q_nearest_distance(spark, sf):
    """Populated hexagon centroid -> nearest facility distance (km)."""
    from hexaccess.operators.nearest import nearest_distance_km
    inp = jobs.load_inputs(spark, sf, P)
    g = jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P)
    pts = g.where("population > 0").select("hex_id", F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y"))
    nn = nearest_distance_km(jobs.materialise(pts), inp.facilities)
    return nn.select("hex_id", r("nearest_facility_km", 6).alias("nearest_facility_km"))


# ============================================================================ shared pieces
# The test box used by the reference's own fixtures, and the
# layer names tried in order when reading the admin boundaries.
FIXTURE_BOX = (27.5, -4.0, 28.0, -3.5)
RUN_TIME = "2024-01-17T00:00:00"


def _inputs(spark, sf):
    return jobs.load_inputs(spark, sf, P)


def _exposure_grid(spark, sf) -> DataFrame:
    inp = _inputs(spark, sf)
    return jobs.materialise(jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P))


def _populated_points(g: DataFrame) -> DataFrame:
    return g.where("population > 0").select("hex_id", F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y"))


def _lonlat_grid(g: DataFrame) -> DataFrame:
    return jobs.to_lonlat_grid(g, P)


def _scratch(spark, name):
    from hexaccess.session import scratch_path
    return scratch_path(spark, name)


# ============================================================================ 2.1 scans and sources

@query("scan_table")
def q_scan_table(spark, sf):
    """S1 + K1: write the facility table, scan it back projected and filtered."""
    from hexaccess.sinks.writers import write_table
    from hexaccess.sources.derived import facilities
    from hexaccess.sources.tables import scan_table
    path = write_table(facilities(spark, sf, P), _scratch(spark, "health_facilities"))
    df = scan_table(spark, path, ["id", "x", "y"], F.col("amenity") == "clinic")
    return df.select("id", r("x", 3).alias("x"), r("y", 3).alias("y"))


@query("sql_query")
def q_sql_query(spark, sf):
    """SQL text over named views with a bound parameter."""
    from hexaccess.sources.derived import facilities
    from hexaccess.sources.tables import sql_query
    return sql_query(
        spark,
        "SELECT amenity, count(*) AS n_facilities, min(id) AS first_id, max(id) AS last_id "
        "FROM health_facilities WHERE id >= :min_id GROUP BY amenity",
        {"health_facilities": facilities(spark, sf, P)}, {"min_id": 0})


def _lake(spark, sf) -> str:
    from hexaccess.sinks.writers import write_table
    from hexaccess.sources.derived import places_lonlat
    return write_table(places_lonlat(spark, sf, P), _scratch(spark, "lake"), partition_by=["theme", "type"])


@query("lake_scan")
def q_lake_scan(spark, sf):
    """S3: hive-partitioned lake with partition columns and file names."""
    from hexaccess.sources.tables import lake_scan
    df = lake_scan(spark, _lake(spark, sf))
    return df.select("id", "theme", "type",
                     F.regexp_extract("filename", r"theme=([^/]+)", 1).alias("file_theme"))


@query("bbox_contained")
def q_bbox_contained(spark, sf):
    """Records whose bbox lies inside the box (pushed into the scan)."""
    from hexaccess.sources.tables import lake_scan
    df = lake_scan(spark, _lake(spark, sf), bbox=FIXTURE_BOX)
    return df.select("id", "theme")


@query("lake_limit")
def q_lake_limit(spark, sf):
    """L1: the subset mode's LIMIT 100, made repeatable by ordering on id."""
    from hexaccess.operators.vector import first_n
    from hexaccess.sources.tables import lake_scan
    df = lake_scan(spark, _lake(spark, sf), bbox=FIXTURE_BOX)
    return first_n(df.select("id", "theme"), 100, ["id"])


@query("geojson_features")
def q_geojson_features(spark, sf):
    """FeatureCollection documents -> rows (written, then read back)."""
    from hexaccess.sinks.writers import geojson_feature, write_feature_collections
    from hexaccess.sources.derived import facilities_lonlat
    from hexaccess.sources.tables import geojson_features
    f = facilities_lonlat(spark, sf, P)
    feat = f.select("id", geojson_feature(
        {"id": F.col("id").cast("string"), "name": F.col("name"), "amenity": F.col("amenity")},
        "Point", F.array("lon", "lat")).alias("feature"))
    path = write_feature_collections(feat, "feature", F.col("id"), _scratch(spark, "facilities_geojson"), per_doc=50)
    g = geojson_features(spark, path)
    return g.select(F.col("id").cast("long").alias("id"), "name", "amenity", "geometry_type",
                    r("lon", 9).alias("lon"), r("lat", 9).alias("lat"))


@query("layer_scan")
def q_layer_scan(spark, sf):
    """First layer name that exists, else the alternative."""
    from hexaccess.sinks.writers import write_table
    from hexaccess.sources.derived import admin_lonlat
    from hexaccess.sources.tables import layer_scan
    admin = admin_lonlat(spark, sf, P)
    region_layer = admin.where("admin_id % 5 = 0").withColumn("layer", F.lit("ADM_ADM_2"))
    level3 = admin.withColumn("layer", F.lit(P.layers[1]))   # only the alternative name is present
    path = write_table(level3.unionByName(region_layer), _scratch(spark, "admin_layers"), partition_by=["layer"])
    return layer_scan(spark, path, list(P.layers)).select("admin_id", "NAME_3", "layer")


@query("raster_cells")
def q_raster_cells(spark, sf):
    """Valid cells of the population raster."""
    from hexaccess.operators.raster import raster_valid
    return raster_valid(_inputs(spark, sf).population).select("row", "col", r("value", 6).alias("value"))


@query("raster_cell_xy")
def q_raster_cell_xy(spark, sf):
    """Cell centre coordinates from (row, col) and the grid header."""
    from hexaccess.operators.raster import raster_cell_xy
    c = raster_cell_xy(_inputs(spark, sf).population)
    return c.select("row", "col", r("x", 9).alias("lon"), r("y", 9).alias("lat"))


@query("nearest_no_facilities")
def q_nearest_no_facilities(spark, sf):
    """An empty facility table leaves every hexagon with NULL access."""
    inp = _inputs(spark, sf)
    g = jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P)
    a = jobs.accessibility(g, inp.facilities.where(F.col("id") < 0), P)
    return a.select("hex_id", "nearest_facility_km", "accessibility_class", "accessibility_score")


# ============================================================================ 2.2 sinks

@query("write_if_absent")
def q_write_if_absent(spark, sf):
    """K2: a second write in ``ignore`` mode keeps the first output."""
    from hexaccess.sinks.writers import write_table
    from hexaccess.sources.derived import facilities
    fac = facilities(spark, sf, P)
    path = write_table(fac.where("amenity = 'clinic'"), _scratch(spark, "if_absent"))
    write_table(fac, path, mode="ignore")
    return spark.read.parquet(path).groupBy("amenity").agg(F.count(F.lit(1)).alias("n_rows"))


@query("update_by_key")
def q_update_by_key(spark, sf):
    """Set-based keyed update of grid columns."""
    from hexaccess.operators.vector import update_by_key
    inp = _inputs(spark, sf)
    grid = jobs.build_grid(inp.admin, P)
    upd = jobs.zonal_exposure(inp.population, inp.flood, P)
    g = update_by_key(grid, upd, "hex_id", ["population", "population_exposed"])
    return g.select("hex_id", r("population", 6).alias("population"),
                    r("population_exposed", 6).alias("population_exposed"))


@query("update_unmatched")
def q_update_unmatched(spark, sf):
    """An update with keys that no base row has, base rows that none names, NULLs, and keys that stand twice."""
    from hexaccess.operators.vector import update_by_key
    from hexaccess.sources.derived import table
    base = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_acctbal").alias("score"))
    key = F.col("c_custkey").cast("long")
    twice = F.when(key % 8 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0)))
    upd = (table(spark, sf, "customer").where(key % 2 == 0)
           .select(key.alias("id"), F.when(key % 3 != 0, F.abs("c_acctbal")).alias("balance"), F.explode(twice).alias("times"))
           .select("id", (F.col("balance") * F.col("times")).alias("score")))
    return update_by_key(base, upd, "id", ["score"]).select("id", r("score", 6).alias("score"))


@query("export_grid")
def q_export_grid(spark, sf):
    """K5: grid results in lon/lat with stored bounding boxes, zstd Parquet, read back."""
    from hexaccess.sinks.outputs import with_bbox
    from hexaccess.sinks.writers import write_table
    g = with_bbox(_lonlat_grid(analysis(spark, sf)), "geometry")
    back = spark.read.parquet(write_table(g, _scratch(spark, "grid_results"), compression=P.compression))
    return back.select("hex_id", F.size("geometry").alias("n_vertices"),
                       r(F.col("centroid.x"), 7).alias("lon"), r(F.col("centroid.y"), 7).alias("lat"),
                       *[r(F.col(f"bbox.{c}"), 7).alias(c) for c in ("xmin", "xmax", "ymin", "ymax")], "priority_class")


@query("export_admin")
def q_export_admin(spark, sf):
    """K5: the admin layer (holes and parts) with stored bounding boxes, read back."""
    from hexaccess.sinks.outputs import with_bbox
    from hexaccess.sinks.writers import write_table
    back = spark.read.parquet(write_table(with_bbox(_shapes(spark, sf), "rings"), _scratch(spark, "admin_results"), compression=P.compression))
    return back.select("admin_id", F.col("part_id").cast("int").alias("part_id"), F.size("rings").alias("n_rings"),
                       *[r(F.col(f"bbox.{c}"), 7).alias(c) for c in ("xmin", "xmax", "ymin", "ymax")])


@query("export_geojson")
def q_export_geojson(spark, sf):
    """K6: populated hexagons as line-delimited GeoJSON features."""
    from hexaccess.sinks.writers import geojson_feature, ring_coordinates, write_geojson_lines
    g = _lonlat_grid(analysis(spark, sf)).where("population > 0")
    feat = g.select(geojson_feature(
        {"hex_id": F.col("hex_id"), "priority_class": F.col("priority_class"),
         "priority_score": F.col("priority_score")},
        "Polygon", ring_coordinates(F.col("geometry"))).alias("f"))
    path = write_geojson_lines(feat, "f", _scratch(spark, "h3_grid_geojson"))
    schema = ("type string, properties struct<hex_id:string, priority_class:string, priority_score:double>, "
              "geometry struct<type:string, coordinates:array<array<array<double>>>>")
    back = spark.read.text(path).select(F.from_json("value", schema).alias("f"))
    return back.select(F.col("f.properties.hex_id").alias("hex_id"), F.col("f.properties.priority_class").alias("priority_class"),
                       F.col("f.geometry.type").alias("geometry_type"),
                       F.size(F.get(F.col("f.geometry.coordinates"), 0)).alias("n_coords"))


@query("raster_exposed")
def q_raster_exposed(spark, sf):
    """K7: the exposed-population raster, stored by block row, read back."""
    from hexaccess.functions import scoring
    from hexaccess.sinks.writers import write_raster
    inp = _inputs(spark, sf)
    cells = jobs.exposure_cells(inp.population, inp.flood, P).select(
        "row", "col", scoring.flood_mask(F.col("depth"), F.col("value")).alias("value"))
    path = write_raster(cells, _scratch(spark, "exposed_population"), block=32)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("tile_row").cast("long").alias("tile_row")).agg(F.count(F.lit(1)).alias("n_cells"), r(F.sum("value"), 6).alias("value_sum"))


@query("raster_blocks")
def q_raster_blocks(spark, sf):
    """K8: storage blocks (block keys and per-block stats)."""
    from hexaccess.operators.raster import raster_blocks
    b = raster_blocks(_inputs(spark, sf).population, block=32)
    return b.select("block_row", "block_col", "n_cells", r("value_sum", 6).alias("value_sum"),
                    r("value_min", 6).alias("value_min"), r("value_max", 6).alias("value_max"))


@query("raster_overview")
def q_raster_overview(spark, sf):
    """K8: overview levels 1 to 4 of both rasters, averaged and nearest, each from the one before."""
    from hexaccess.operators.raster import raster_overviews
    from hexaccess.sources.raster import Raster
    inp, out = _inputs(spark, sf), None
    # population counts have six decimals: their sums are kept exact
    exact = Raster(inp.population.cells.withColumn("value", F.col("value").cast("decimal(18,6)")), inp.population.meta)
    for name, raster in (("population", exact), ("flood", inp.flood)):
        for how in ("avg", "nearest"):
            for level, df in raster_overviews(raster, 4, how).items():
                one = df.select(F.lit(name).alias("raster"), F.lit(how).alias("how"), F.lit(level).alias("level"),
                                "row", "col", r("value", 6).cast("double").alias("value"))
                out = one if out is None else out.unionByName(one)
    return out


def _tiles(spark, sf):
    from hexaccess.operators.tiles import tile_features
    g = _lonlat_grid(analysis(spark, sf)).where("population > 0")
    return tile_features(g, range(P.min_zoom, P.max_zoom + 1), ring="geometry", keep=["priority_score"])


@query("tile_features")
def q_tile_features(spark, sf):
    """K9: feature rows keyed by (zoom, tile_x, tile_y) of both layers: populated hexagons with their
    eight attributes (counted where not null), and facilities."""
    from hexaccess.sinks.outputs import HEX_TILE_ATTRIBUTES, tile_layers
    from hexaccess.sources.derived import facilities_lonlat
    layers = tile_layers(_lonlat_grid(analysis(spark, sf)), facilities_lonlat(spark, sf, P), P)
    filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in HEX_TILE_ATTRIBUTES), F.lit(0))
    hexes = layers["hexagon_tiles"].select(F.lit("hexagons").alias("layer"), "zoom", "tile_x", "tile_y", filled.alias("n"))
    points = layers["facility_tiles"].select(F.lit("facilities").alias("layer"), "zoom", "tile_x", "tile_y", F.lit(2).alias("n"))
    return hexes.unionByName(points).groupBy("layer", F.col("zoom").cast("long").alias("zoom"), "tile_x", "tile_y").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("n").cast("long").alias("n_values"))


@query("tile_thin")
def q_tile_thin(spark, sf):
    """K9: at most the parameter's features per tile, highest priority first, and how many it drops."""
    from hexaccess.operators.tiles import tile_thin
    t = tile_thin(_tiles(spark, sf), P.max_features_per_tile, [F.col("priority_score").desc()])
    return t.select(F.col("zoom").cast("long").alias("zoom"), "tile_x", "tile_y", "hex_id",
                    F.col("tile_rank").cast("long").alias("tile_rank"), "n_dropped")


@query("output_manifest")
def q_output_manifest(spark, sf):
    """A run's outputs written and its manifest: every asset with rows, extent, media type and run time."""
    from hexaccess.sinks.outputs import write_outputs
    inp = _inputs(spark, sf)
    base = _scratch(spark, "outputs")
    m = write_outputs(jobs.pipeline_from_inputs(inp, P), inp.population, inp.flood, P, base, RUN_TIME)
    return m.select("asset", "n_rows", r("xmin", 7).alias("xmin"), r("ymin", 7).alias("ymin"), r("xmax", 7).alias("xmax"),
                    r("ymax", 7).alias("ymax"), "media_type", "created",
                    F.substring_index("path", "/", -1).alias("folder"),
                    F.get_json_object("study", "$.analysis_crs").alias("study_crs"))


# ============================================================================ 2.3 projections and filters

@query("filter_populated")
def q_filter_populated(spark, sf):
    """Populated hexagons only."""
    g = _exposure_grid(spark, sf)
    return g.where("population > 0").select("hex_id", r("population", 6).alias("population"))


@query("bbox_points")
def q_bbox_points(spark, sf):
    """Facilities inside an extent."""
    from hexaccess.sources.derived import facilities_lonlat
    from hexaccess.sources.tables import bbox_points
    f = bbox_points(facilities_lonlat(spark, sf, P), *FIXTURE_BOX)
    return f.select("id", r("lon", 9).alias("lon"), r("lat", 9).alias("lat"))


@query("project_rename")
def q_project_rename(spark, sf):
    """Projection with rename (centroid AS geometry) of populated hexagons."""
    g = _exposure_grid(spark, sf).where("population > 0").select("hex_id", F.col("centroid").alias("geometry"))
    return g.select("hex_id", r(F.col("geometry.x"), 3).alias("geometry_x"), r(F.col("geometry.y"), 3).alias("geometry_y"))


@query("map_layer")
def q_map_layer(spark, sf):
    """P5: the map layer: 8 attributes + geometry of populated hexagons."""
    g = _lonlat_grid(analysis(spark, sf)).where("population > 0")
    return g.select("hex_id", r("population", 6).alias("population"), r("population_exposed", 6).alias("population_exposed"),
                    r("exposure_pct", 6).alias("exposure_pct"), r("nearest_facility_km", 6).alias("nearest_facility_km"),
                    "accessibility_class", r("priority_score", 6).alias("priority_score"), "priority_class",
                    F.size("geometry").alias("n_vertices"))


@query("grid_columns")
def q_grid_columns(spark, sf):
    """Constant and derived grid columns (resolution, area)."""
    g = jobs.build_grid(_inputs(spark, sf).admin, P)
    return g.select("hex_id", "resolution", r("area_km2", 6).alias("area_km2"))


@query("null_repair")
def q_null_repair(spark, sf):
    """NULL/zero repair: divisor 0 -> 1, NaN -> 0, missing score -> 0."""
    from hexaccess.functions import scoring
    g = analysis(spark, sf)
    pop = F.col("population")
    return g.select("hex_id", r(F.when(pop == 0, F.lit(1.0)).otherwise(pop), 6).alias("pop_divisor"),
                    r(scoring.exposure_pct(F.col("population_exposed"), pop), 6).alias("exposure_pct"),
                    r(scoring.inaccessibility(F.col("accessibility_score")), 6).alias("inaccessibility"))


@query("null_repair_cases")
def q_null_repair_cases(spark, sf):
    """The repairs on rows whose population, exposed population or score is 0, NULL or NaN, by the customer's key."""
    from hexaccess.functions import scoring
    from hexaccess.sources.derived import table
    k, nan = F.col("c_custkey").cast("long"), F.lit(float("nan"))
    people = F.abs("c_acctbal") + F.lit(1.0)
    rows = table(spark, sf, "customer").select(
        k.alias("id"),
        F.when(k % 5 == 0, F.lit(0.0)).when(k % 5 == 1, F.lit(None).cast("double")).when(k % 5 == 2, nan).otherwise(people).alias("population"),
        F.when(k % 3 == 0, F.lit(None).cast("double")).when(k % 3 == 1, people / F.lit(2.0)).otherwise(nan).alias("exposed"),
        F.when(k % 4 == 0, F.lit(None).cast("double")).when(k % 4 == 1, nan).otherwise(F.lit(0.25)).alias("score"))
    return rows.select("id", r(scoring.exposure_pct("exposed", "population"), 6).alias("exposure_pct"),
                       r(scoring.inaccessibility("score"), 6).alias("inaccessibility"),
                       r(scoring.priority_score(F.lit(0.5), "score"), 6).alias("priority_score"))


def _test_rings(spark, sf) -> DataFrame:
    """Admin rings with deliberate defects by ``admin_id % 5``: 0 as is,
    1 closing point dropped, 2 a vertex repeated, 3 two vertices swapped
    with the 4th moved north (an uneven bow-tie), 4 clockwise."""
    from hexaccess.functions import geo
    from hexaccess.sources.derived import admin_lonlat
    a = admin_lonlat(spark, sf, P)
    ring = F.col("ring")
    v = F.col("admin_id") % 5
    bad = (F.when(v == 1, F.slice(ring, 1, 4))
           .when(v == 2, F.concat(F.slice(ring, 1, 2), F.slice(ring, 2, 4)))
           .when(v == 3, F.array(F.get(ring, 0), F.get(ring, 2), F.get(ring, 1), geo.point(
               F.get(ring, 3)["x"], F.get(ring, 3)["y"] + (F.get(ring, 3)["y"] - F.get(ring, 0)["y"])), F.get(ring, 4)))
           .when(v == 4, F.reverse(ring))
           .otherwise(ring))
    return a.select("admin_id", bad.alias("ring"))


@query("geom_valid")
def q_geom_valid(spark, sf):
    """Validity test of rings."""
    from hexaccess.operators.vector import validate
    return validate(_test_rings(spark, sf)).select("admin_id", "valid", "invalid_reason")


@query("geom_edge_faults")
def q_geom_edge_faults(spark, sf):
    """Edges of a ring that cross or touch each other, by buckets of edges."""
    from hexaccess.operators.validity import edge_faults
    return edge_faults(_test_rings(spark, sf))


@query("geom_repair")
def q_geom_repair(spark, sf):
    """Repaired rings and the reject table, as one tagged result."""
    from hexaccess.functions import polygon
    from hexaccess.operators.vector import repair
    ok, rejects = repair(_test_rings(spark, sf))
    good = ok.select("admin_id", F.lit(False).alias("rejected"), F.size("ring").alias("n_points"),
                     r(polygon.signed_area(F.col("ring")), 9).alias("signed_area"))
    bad = rejects.select("admin_id", F.lit(True).alias("rejected"), F.size("ring").alias("n_points"),
                         F.lit(None).cast("double").alias("signed_area"))
    return good.unionByName(bad)


# ============================================================================ 2.4 joins

@query("nearest_facility")
def q_nearest_facility(spark, sf):
    """Nearest facility with its id, every populated hexagon."""
    from hexaccess.operators.nearest import nearest
    g = _exposure_grid(spark, sf)
    nn = nearest(_populated_points(g), _inputs(spark, sf).facilities, k=1)
    return nn.select("hex_id", "facility_id", r(F.col("distance_m") / 1000.0, 6).alias("distance_km"))


@query("knn_facilities")
def q_knn_facilities(spark, sf):
    """J2 (k > 1): three nearest facilities per populated hexagon."""
    from hexaccess.operators.nearest import nearest
    g = _exposure_grid(spark, sf)
    nn = nearest(_populated_points(g), _inputs(spark, sf).facilities, k=3)
    return nn.select("hex_id", "rank", "facility_id", r(F.col("distance_m") / 1000.0, 6).alias("distance_km"))


@query("zonal_hex")
def q_zonal_hex(spark, sf):
    """Population summed per hexagon by arithmetic assignment (all hexagons hit)."""
    from hexaccess.operators.raster import raster_cell_xy
    from hexaccess.operators.zonal import zonal_hex
    cells = jobs.to_analysis_crs(raster_cell_xy(_inputs(spark, sf).population), "EPSG:4326", P)
    z = zonal_hex(cells, P.resolution, {"population": "value", "n_cells": F.lit(1)}, "_ux", "_uy")
    return z.select("hex_id", r("population", 6).alias("population"), F.col("n_cells").cast("long").alias("n_cells"))


@query("zonal_polygon")
def q_zonal_polygon(spark, sf):
    """Weighted points summed per admin polygon (bucket join + ray cast), in UTM."""
    from hexaccess.functions import geo
    from hexaccess.operators.zonal import zonal_polygon
    from hexaccess.sources.derived import admin_shapes_lonlat, pop_points
    pts = geo.with_utm(pop_points(spark, sf, P), "lon", "lat", "x", "y")
    zones = admin_shapes_lonlat(spark, sf, P).select(
        F.col("admin_id").alias("zone_id"), F.transform("rings", lambda ring: geo.ring_to_utm(ring)).alias("ring"))
    z = zonal_polygon(pts.withColumnRenamed("weight", "value"), zones, 20000.0)
    return z.select(F.col("zone_id").alias("admin_id"), r("value_sum", 6).alias("value_sum"), "n_points")


@query("raster_align")
def q_raster_align(spark, sf):
    """Flood depth at population cell centres (nearest; 0 outside)."""
    from hexaccess.operators.raster import raster_align
    inp = _inputs(spark, sf)
    a = raster_align(inp.population, inp.flood, name="depth", fill=0.0)
    return a.select("row", "col", r("depth", 6).alias("depth"))


@query("clip_to_box")
def q_clip_to_box(spark, sf):
    """Admin polygons intersected with a box."""
    from hexaccess.functions import polygon
    from hexaccess.operators.vector import clip_layer_to_box
    from hexaccess.sources.derived import admin_lonlat
    c = clip_layer_to_box(admin_lonlat(spark, sf, P), *FIXTURE_BOX)
    bb = polygon.ring_bbox(F.col("ring"))
    return c.where(polygon.polygon_area(F.col("ring")) > 0).select(
        "admin_id", r(polygon.polygon_area(F.col("ring")), 9).alias("area"),
        r(bb["xmin"], 9).alias("xmin"), r(bb["xmax"], 9).alias("xmax"),
        r(bb["ymin"], 9).alias("ymin"), r(bb["ymax"], 9).alias("ymax"))


def _hex_admin(spark, sf, g: DataFrame | None = None) -> DataFrame:
    inp = _inputs(spark, sf)
    g = g if g is not None else jobs.build_grid(inp.admin, P)
    return jobs.hex_admin_units(g, inp.admin, P)


def _shapes(spark, sf) -> DataFrame:
    from hexaccess.sources.derived import admin_shapes_lonlat
    return admin_shapes_lonlat(spark, sf, P)


@query("hex_admin")
def q_hex_admin(spark, sf):
    """The admin unit (with holes and parts) containing each hexagon centre."""
    return jobs.hex_admin_units(jobs.build_grid(_inputs(spark, sf).admin, P), _shapes(spark, sf), P, ring="rings")


@query("hex_polyfill")
def q_hex_polyfill(spark, sf):
    """Hexagons whose centre lies in each admin polygon."""
    from hexaccess.operators.grid import hex_polyfill
    return hex_polyfill(_shapes(spark, sf), P.resolution, P, ring_col="rings").select("admin_id", "hex_id")


@query("hex_polyfill_multi")
def q_hex_polyfill_multi(spark, sf):
    """Polyfill of the union of all parts (no dissolve)."""
    from hexaccess.operators.grid import hex_polyfill_union
    return hex_polyfill_union(_shapes(spark, sf), P.resolution, P, ring_col="rings").select("hex_id")


# ============================================================================ 2.5 aggregations

@query("minmax_normalize")
def q_minmax_normalize(spark, sf):
    """Exposed population min-max scaled over populated hexagons."""
    g = jobs.priority_scores(_access_grid_materialised(spark, sf), P)
    return g.where("population > 0").select("hex_id", r("exposure_score", 6).alias("exposure_score"))


def _access_grid_materialised(spark, sf):
    inp = _inputs(spark, sf)
    g = jobs.materialise(jobs.exposure(jobs.build_grid(inp.admin, P), inp.population, inp.flood, P))
    return jobs.materialise(jobs.accessibility(g, inp.facilities, P, materialise_input=False))


@query("score_percentiles")
def q_score_percentiles(spark, sf):
    """A5: exact interpolated percentiles (100 - top, 50) of priority scores."""
    scored = jobs.priority_scores(_access_grid_materialised(spark, sf), P)
    hi, mid = jobs.priority_thresholds(scored, P)
    return spark.createDataFrame([(hi, mid)], "p_high double, p_mid double").select(
        r("p_high", 9).alias("p_high"), r("p_mid", 9).alias("p_mid"))


@query("population_totals")
def q_population_totals(spark, sf):
    """Totals, high-priority population and share."""
    from hexaccess.operators.summaries import population_totals
    t = population_totals(analysis(spark, sf))
    return t.select(*[r(c, 6).alias(c) for c in t.columns])


@query("class_counts")
def q_class_counts(spark, sf):
    """Hexagons per priority class."""
    from hexaccess.operators.summaries import class_counts
    return class_counts(analysis(spark, sf))


@query("access_summary")
def q_access_summary(spark, sf):
    """Mean distance and count strictly beyond moderate_km."""
    from hexaccess.operators.summaries import access_summary
    s = access_summary(_access_grid_materialised(spark, sf), P.moderate_km)
    return s.select(r("avg_distance_km", 6).alias("avg_distance_km"), "n_poor_access", "n_hexes")


@query("run_summary")
def q_run_summary(spark, sf):
    """The one-row run summary."""
    from hexaccess.operators.summaries import run_summary
    s = run_summary(analysis(spark, sf))
    return s.select("total_hexes", r("total_population", 6).alias("total_population"),
                    r("exposed_population", 6).alias("exposed_population"), "high_priority_hexes",
                    r("avg_facility_distance_km", 6).alias("avg_facility_distance_km"))


@query("table_count")
def q_table_count(spark, sf):
    """A10: row counts of the analysis tables."""
    from hexaccess.operators.stats import table_count
    inp = _inputs(spark, sf)
    parts = {"admin_boundaries": inp.admin, "health_facilities": inp.facilities,
             "h3_grid": jobs.build_grid(inp.admin, P), "population_cells": inp.population.cells,
             "no_rows": inp.facilities.where("id < 0")}
    out = None
    for name, df in parts.items():
        one = table_count(df).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("layer_extent")
def q_layer_extent(spark, sf):
    """Extent of the admin layer."""
    from hexaccess.operators.summaries import layer_extent
    e = layer_extent(_inputs(spark, sf).admin)
    return e.select(*[r(c, 9).alias(c) for c in e.columns])


@query("admin_rollup")
def q_admin_rollup(spark, sf):
    """Hexagon results rolled up to admin units, with subtotals."""
    inp = _inputs(spark, sf)
    out = jobs.admin_rollup(analysis(spark, sf), inp.admin, P)
    return out.select("NAME_0", "NAME_3", "n_hexes", r("population", 6).alias("population"),
                      r("population_exposed", 6).alias("population_exposed"),
                      r("weighted_distance_km", 6).alias("weighted_distance_km"), "high_priority_hexes")


@query("hex_parent_rollup")
def q_hex_parent_rollup(spark, sf):
    """Results rolled up to the next coarser hexagon level."""
    from hexaccess.operators.grid import hex_parent_rollup
    p = hex_parent_rollup(_exposure_grid(spark, sf), P.resolution)
    return p.select("parent_id", "n_children", r("population", 6).alias("population"),
                    r("population_exposed", 6).alias("population_exposed"))


# ============================================================================ 2.6 limits

@query("first_n")
def q_first_n(spark, sf):
    """L2: subset mode: first admin unit and first 5 facilities by id."""
    from hexaccess.operators.vector import first_n
    inp = _inputs(spark, sf)
    a = first_n(inp.admin.select(F.lit("admin").alias("kind"), F.col("admin_id").alias("id")), 1, ["id"])
    f = first_n(inp.facilities.select(F.lit("facility").alias("kind"), "id"), 5, ["id"])
    return a.unionByName(f)


@query("top_priority")
def q_top_priority(spark, sf):
    """L4: the high-priority hexagons."""
    return jobs.top_priority(analysis(spark, sf)).select("hex_id", r("priority_score", 6).alias("priority_score"))


# ============================================================================ 2.7 scalar functions

@query("to_utm")
def q_to_utm(spark, sf):
    """lon/lat -> UTM 35S (one point per customer)."""
    from hexaccess.functions import geo
    from hexaccess.sources.derived import pop_points
    u = geo.with_utm(pop_points(spark, sf, P), "lon", "lat", "x", "y")
    return u.select("pid", r("x", 3).alias("x"), r("y", 3).alias("y"))


@query("to_lonlat")
def q_to_lonlat(spark, sf):
    """UTM -> lon/lat (facility points back to degrees)."""
    from hexaccess.functions import geo
    f = geo.with_lonlat(_inputs(spark, sf).facilities, "x", "y", "lon", "lat")
    return f.select("id", r("lon", 9).alias("lon"), r("lat", 9).alias("lat"))


def _admin_utm(spark, sf) -> DataFrame:
    from hexaccess.functions import geo
    return _shapes(spark, sf).select("admin_id", F.col("part_id").cast("int").alias("part_id"),
                                     F.transform("rings", lambda ring: geo.ring_to_utm(ring)).alias("rings"))


@query("polygon_area")
def q_polygon_area(spark, sf):
    """polygon area (shoelace, holes off) in km^2 of the projected admin parts."""
    from hexaccess.functions import polygon
    a = _admin_utm(spark, sf)
    return a.select("admin_id", "part_id", r(polygon.rings_area(F.col("rings")) / F.lit(1.0e6), 6).alias("area_km2"))


@query("polygon_centroid")
def q_polygon_centroid(spark, sf):
    """area-weighted centroid (holes count against) of the projected admin parts."""
    from hexaccess.functions import polygon
    a = _admin_utm(spark, sf).select("admin_id", "part_id", polygon.rings_centroid(F.col("rings")).alias("c"))
    return a.select("admin_id", "part_id", r(F.col("c.x"), 3).alias("cx"), r(F.col("c.y"), 3).alias("cy"))


@query("polygon_wkt")
def q_polygon_wkt(spark, sf):
    """F8: EWKT of the admin parts with all rings, and the rings read back from it."""
    from hexaccess.functions import geo
    t = _shapes(spark, sf).select("admin_id", F.col("part_id").cast("int").alias("part_id"),
                                  geo.rings_to_wkt(F.col("rings"), F.lit(4326), digits=7).alias("wkt"))
    return t.withColumn("n_rings", F.size(geo.wkt_to_rings(F.col("wkt"))).cast("long"))


@query("hex_wkt")
def q_hex_wkt(spark, sf):
    """F8: EWKT of each hexagon's polygon and centroid."""
    from hexaccess.functions import geo
    g = jobs.build_grid(_inputs(spark, sf).admin, P)
    srid = geo.parse_epsg(F.lit(P.analysis_crs))
    return g.select("hex_id", geo.ring_to_wkt(F.col("geometry"), srid, digits=3).alias("geometry_wkt"),
                    geo.point_to_wkt(F.col("centroid.x"), F.col("centroid.y"), srid, digits=3).alias("centroid_wkt"))


@query("distance_km")
def q_distance_km(spark, sf):
    """distance from each facility to the centre of the hexagon it falls in."""
    from hexaccess.functions import geo, hexgrid
    f = hexgrid.with_hex_axial(_inputs(spark, sf).facilities, "x", "y", P.resolution)
    f = f.withColumn("hex_id", hexgrid.hex_id(F.lit(P.resolution), F.col("q"), F.col("r")))
    c = hexgrid.hex_center(F.col("q"), F.col("r"), P.resolution)
    return f.select("id", "hex_id", r(geo.distance_km(F.col("x"), F.col("y"), c["x"], c["y"]), 6).alias("distance_km"))


@query("box_ring")
def q_box_ring(spark, sf):
    """box polygon (closed ring) from each admin unit's bounds."""
    from hexaccess.functions import geo, polygon
    a = _inputs(spark, sf).admin.select("admin_id", polygon.ring_bbox(F.col("ring")).alias("b"))
    ring = geo.box_ring(F.col("b.xmin"), F.col("b.ymin"), F.col("b.xmax"), F.col("b.ymax"))
    return a.select("admin_id", F.posexplode(ring).alias("i", "p")).select(
        "admin_id", "i", r(F.col("p.x"), 9).alias("x"), r(F.col("p.y"), 9).alias("y"))


@query("hex_assign")
def q_hex_assign(spark, sf):
    """hexagon id of each customer point."""
    from hexaccess.functions import geo, hexgrid
    from hexaccess.sources.derived import pop_points
    u = geo.with_utm(pop_points(spark, sf, P), "lon", "lat", "x", "y")
    return hexgrid.with_hex_assign(u, "x", "y", P.resolution).select("pid", "hex_id")


@query("hex_boundary")
def q_hex_boundary(spark, sf):
    """boundary ring vertices of every grid hexagon."""
    g = jobs.build_grid(_inputs(spark, sf).admin, P)
    return g.select("hex_id", F.posexplode("geometry").alias("i", "p")).select(
        "hex_id", "i", r(F.col("p.x"), 3).alias("x"), r(F.col("p.y"), 3).alias("y"))


@query("to_wkt")
def q_to_wkt(spark, sf):
    """F8: EWKT text of facility points."""
    from hexaccess.functions import geo
    f = _inputs(spark, sf).facilities
    return f.select("id", geo.point_to_wkt(F.col("x"), F.col("y"), geo.parse_epsg(F.lit(P.analysis_crs)), digits=3).alias("wkt"))


@query("from_wkt")
def q_from_wkt(spark, sf):
    """F8: EWKT text parsed back to SRID and coordinates."""
    from hexaccess.functions import geo
    f = _inputs(spark, sf).facilities.select(
        "id", geo.point_to_wkt(F.col("x"), F.col("y"), F.lit(32735), digits=3).alias("wkt"))
    pts = f.select("id", geo.wkt_srid(F.col("wkt")).alias("srid"), geo.wkt_to_ring(F.col("wkt")).alias("pts"))
    return pts.select("id", "srid", F.get(F.col("pts"), 0)["x"].alias("x"), F.get(F.col("pts"), 0)["y"].alias("y"))


@query("point_in_ring")
def q_point_in_ring(spark, sf):
    """the admin unit (lon/lat ring) containing each customer point."""
    from hexaccess.operators.zonal import point_in_zone
    from hexaccess.sources.derived import pop_points
    zones = _shapes(spark, sf).select(F.col("admin_id").alias("zone_id"), F.col("rings").alias("ring"))
    hit = point_in_zone(pop_points(spark, sf, P), zones, 0.1, "lon", "lat")
    return hit.select("pid", F.col("zone_id").alias("admin_id"))


@query("flood_mask")
def q_flood_mask(spark, sf):
    """exposed population per cell (depth > 0)."""
    from hexaccess.functions import scoring
    inp = _inputs(spark, sf)
    c = jobs.exposure_cells(inp.population, inp.flood, P)
    return c.select("row", "col", r(scoring.flood_mask(F.col("depth"), F.col("value")), 6).alias("exposed"))


@query("exposure_pct")
def q_exposure_pct(spark, sf):
    """exposure percent per hexagon (population 0 -> 0 %)."""
    g = _exposure_grid(spark, sf)
    return g.select("hex_id", r("exposure_pct", 6).alias("exposure_pct"))


@query("access_class")
def q_access_class(spark, sf):
    """accessibility class (strict <) per populated hexagon."""
    g = _access_grid_materialised(spark, sf)
    return g.where("population > 0").select("hex_id", "accessibility_class")


@query("access_score")
def q_access_score(spark, sf):
    """piecewise-linear accessibility score, floored at 0."""
    g = _access_grid_materialised(spark, sf)
    return g.where("population > 0").select("hex_id", r("accessibility_score", 6).alias("accessibility_score"))


@query("priority_score")
def q_priority_score(spark, sf):
    """Inaccessibility and weighted priority score."""
    g = jobs.priority_scores(_access_grid_materialised(spark, sf), P).where("population > 0")
    from hexaccess.functions import scoring
    return g.select("hex_id", r(scoring.inaccessibility(F.col("accessibility_score")), 6).alias("inaccessibility"),
                    r("priority_score", 6).alias("priority_score"))


@query("priority_class")
def q_priority_class(spark, sf):
    """priority class from the percentile thresholds."""
    return analysis(spark, sf).where("population > 0").select("hex_id", "priority_class")


@query("raster_clip")
def q_raster_clip(spark, sf):
    """population cells with centre inside the box, window re-based."""
    from hexaccess.operators.raster import raster_clip_box
    c = raster_clip_box(_inputs(spark, sf).population, *FIXTURE_BOX)
    return c.cells.select("row", "col", r("value", 6).alias("value"))


@query("raster_clip_zones")
def q_raster_clip_zones(spark, sf):
    """population cells whose centre is inside each admin unit (holes, concave rings, several parts), re-based to its window."""
    from hexaccess.operators.raster import raster_clip_zones, zone_windows
    from hexaccess.sources.derived import admin_shapes_lonlat
    pop, zones = _inputs(spark, sf).population, admin_shapes_lonlat(spark, sf, P)
    cells = raster_clip_zones(pop, zones, "admin_id", "rings")
    windows = zone_windows(zones, pop.meta, "admin_id", "rings")
    return cells.join(windows, "admin_id").select(
        "admin_id", (F.col("row") - F.col("row0")).alias("row"), (F.col("col") - F.col("col0")).alias("col"),
        "n_rows", "n_cols", r("value", 6).alias("value"))


@query("raster_pyramid")
def q_raster_pyramid(spark, sf):
    """K8: the population raster stored with its overview levels; each level read back by its cell width, summed by storage block."""
    from hexaccess.operators.raster import write_pyramid
    from hexaccess.sources.raster import read_overview
    pop = _inputs(spark, sf).population
    path, out = _scratch(spark, "pyramid"), None
    for level in write_pyramid(pop, path, levels=4, how="nearest", block=16):
        stored = read_overview(spark, path, cell=pop.meta.dx * 2 ** level * 1.5)
        one = stored.cells.groupBy(F.col("tile_row").cast("long").alias("tile_row"), F.col("tile_col").cast("long").alias("tile_col")).agg(
            F.count(F.lit(1)).alias("n_cells"), r(F.sum("value"), 6).alias("value_sum")).select(
            F.lit(level).alias("level"), F.lit(stored.meta.n_rows).cast("long").alias("n_rows"), F.lit(stored.meta.n_cols).cast("long").alias("n_cols"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("raster_bilinear")
def q_raster_bilinear(spark, sf):
    """population resampled bilinearly onto the flood grid."""
    from hexaccess.operators.raster import raster_bilinear
    inp = _inputs(spark, sf)
    b = raster_bilinear(inp.population, inp.flood.meta.with_shape(nodata=None))
    return b.select("row", "col", r("value", 9).alias("value"))


@query("raster_nearest")
def q_raster_nearest(spark, sf):
    """flood raster reprojected to UTM by nearest, target grid from the source bounds."""
    from hexaccess.operators.raster import raster_nearest, target_grid_meta
    inp = _inputs(spark, sf)
    dst = target_grid_meta(spark, inp.flood.meta, P.analysis_crs)
    n = raster_nearest(inp.flood, dst)
    return n.select("row", "col", r("value", 6).alias("value"))


@query("raster_valid")
def q_raster_valid(spark, sf):
    """flood cells that are not nodata (0) or NaN."""
    from hexaccess.operators.raster import raster_valid
    return raster_valid(_inputs(spark, sf).flood).select("row", "col", r("value", 6).alias("value"))


@query("exposure_bins")
def q_exposure_bins(spark, sf):
    """legend bins of exposed population."""
    from hexaccess.operators.summaries import exposure_bins
    return exposure_bins(_exposure_grid(spark, sf))


@query("hex_popup")
def q_hex_popup(spark, sf):
    """the hexagon popup text with its defaults."""
    from hexaccess.functions.display import hex_popup
    return hex_popup(analysis(spark, sf))


@query("facility_popup")
def q_facility_popup(spark, sf):
    """the facility popup text with its defaults."""
    from hexaccess.functions.display import facility_popup
    f = _inputs(spark, sf).facilities
    f = f.withColumn("name", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("name")))
    return facility_popup(f)


@query("parse_epsg")
def q_parse_epsg(spark, sf):
    """SRID number from a column of CRS texts (a UTM zone per facility)."""
    from hexaccess.functions import geo
    f = _inputs(spark, sf).facilities.select("id", F.concat(F.lit("EPSG:"), (F.lit(32701) + F.col("id") % 60).cast("string")).alias("crs"))
    return f.select("id", geo.parse_epsg(F.col("crs")).alias("srid"))


@query("tile_xy")
def q_tile_xy(spark, sf):
    """web-map tile of each facility at zoom 12."""
    from hexaccess.functions import geo
    from hexaccess.sources.derived import facilities_lonlat
    f = facilities_lonlat(spark, sf, P)
    t = geo.tile_xy(F.col("lon"), F.col("lat"), F.lit(12))
    return f.select("id", t["x"].alias("tile_x"), t["y"].alias("tile_y"))


# ============================================================================ 2.8 composite jobs

@query("admin_prepare")
def q_admin_prepare(spark, sf):
    """Layer scan -> overlay with the box -> UTM -> validity repair."""
    from hexaccess.plans.prepare import admin_prepare
    ok, rejects = admin_prepare(spark, sf, P, box=P.bbox, scratch=_scratch(spark, "admin_layers"))
    from hexaccess.functions import polygon
    both = ok.withColumn("invalid_reason", F.lit(None).cast("string")).unionByName(rejects)
    return both.select("admin_id", "NAME_3", "invalid_reason",
                       r(polygon.polygon_area(F.col("ring")) / F.lit(1.0e6), 6).alias("area_km2"))


@query("population_prepare")
def q_population_prepare(spark, sf):
    """Population raster clipped to the box, cell centres in UTM."""
    from hexaccess.plans.prepare import population_prepare
    c = population_prepare(spark, sf, P, box=P.bbox)
    return c.select("row", "col", r("value", 6).alias("value"), r("x", 3).alias("x"), r("y", 3).alias("y"))


@query("facility_prepare")
def q_facility_prepare(spark, sf):
    """GeoJSON facilities -> extent filter -> UTM."""
    from hexaccess.plans.prepare import facility_prepare
    f = facility_prepare(spark, sf, P, box=P.bbox, scratch=_scratch(spark, "facilities_geojson"))
    return f.select("id", "name", "amenity", r("x", 3).alias("x"), r("y", 3).alias("y"))


@query("lake_theme_prepare")
def q_lake_theme_prepare(spark, sf):
    """Lake themes contained in the box, geometry in UTM."""
    from hexaccess.plans.prepare import lake_theme_prepare
    t = lake_theme_prepare(spark, _lake(spark, sf), P, box=P.bbox)
    return t.groupBy("theme").agg(F.count(F.lit(1)).alias("n_features"), r(F.min("x"), 3).alias("xmin"),
                                  r(F.max("x"), 3).alias("xmax"))


@query("lake_shapes")
def q_lake_shapes(spark, sf):
    """Polygon and line themes of the lake (WKT), contained in the box, projected: area and length per theme."""
    from hexaccess.plans.prepare import lake_theme_prepare
    from hexaccess.sinks.writers import write_table
    from hexaccess.sources.derived import lake_shapes_lonlat
    lake = write_table(lake_shapes_lonlat(spark, sf, P), _scratch(spark, "lake_shapes"), partition_by=["theme", "type"])
    t = lake_theme_prepare(spark, lake, P, box=P.bbox)
    return t.groupBy("theme", "geometry_type").agg(
        F.count(F.lit(1)).alias("n_features"), r(F.sum("area_m2"), 1).alias("area_m2"), r(F.sum("length_m"), 3).alias("length_m"))


@query("theme_count_by_hex")
def q_theme_count_by_hex(spark, sf):
    """Lake places counted per grid hexagon."""
    from hexaccess.plans.prepare import lake_theme_prepare
    inp = _inputs(spark, sf)
    t = lake_theme_prepare(spark, _lake(spark, sf), P, box=P.bbox)
    from hexaccess.functions import hexgrid
    h = hexgrid.with_hex_assign(t, "x", "y", P.resolution).groupBy("hex_id").agg(F.count(F.lit(1)).alias("n_places"))
    g = jobs.build_grid(inp.admin, P).select("hex_id").join(h, "hex_id", "left")
    return g.withColumn("n_places", F.coalesce("n_places", F.lit(0)))


# ============================================================================ 2.9 graph

def _road_edges(spark, sf):
    from hexaccess.operators.graph import road_edges
    from hexaccess.sources.derived import road_segments_lonlat
    return road_edges(road_segments_lonlat(spark, sf, P), tol=0.001)


@query("road_edges")
def q_road_edges(spark, sf):
    """G1: road segments -> edges with length and snapped end nodes."""
    e = _road_edges(spark, sf)
    return e.select("id", "source", "target", r("length_m", 3).alias("length_m"))


def _far_roads(spark, sf):
    """(edges, nodes) of the roads whose nodes are no facilities."""
    from hexaccess.functions import geo
    from hexaccess.operators.graph import road_edges, snap_node
    from hexaccess.sources.derived import far_road_segments_lonlat
    lines = far_road_segments_lonlat(spark, sf, P)
    ends = lines.select(F.explode("line").alias("p")).select(F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    ends = geo.with_utm(ends, "lon", "lat", "x", "y", P.utm_zone, P.south_hemisphere)
    nodes = ends.groupBy(snap_node(F.col("x"), F.col("y"), 0.001).alias("node")).agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return jobs.materialise(road_edges(lines, tol=0.001)), jobs.materialise(nodes)


@query("network_distance")
def q_network_distance(spark, sf):
    """Distance along the roads from the nearest source to every node: chains contracted, nodes settled in
    buckets.  Every supplier's road start is a source.  Costs are whole millimetres, whose sums are exact in any order."""
    from hexaccess.operators.graph import network_distance
    from hexaccess.sources.derived import table
    e, _ = _far_roads(spark, sf)
    src = e.join(table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("id")), "id").select(F.col("source").alias("node"))
    d = network_distance(e.withColumn("cost", F.round(F.col("length_m") * 1000.0)), src)
    return d.select("node", (F.col("dist") / 1000.0).alias("dist_m"))


@query("network_access")
def q_network_access(spark, sf):
    """Accessibility along the road network (all facilities and hexagons snapped to their nearest nodes)."""
    inp = _inputs(spark, sf)
    g = jobs.accessibility(_exposure_grid(spark, sf), inp.facilities, P, network=_far_roads(spark, sf))
    return g.where("population > 0").select("hex_id", r("nearest_facility_km", 3).alias("nearest_facility_km"), "accessibility_class")


# ============================================================================ streaming

@query("exposure_stream")
def q_exposure_stream(spark, sf):
    """Exposure totals maintained incrementally from raster blocks arriving
    as files (Structured Streaming, stateful aggregation)."""
    from hexaccess.streaming.exposure_stream import run_exposure_stream
    out = run_exposure_stream(spark, _inputs(spark, sf), P, _scratch(spark, "stream"))
    return out.select("hex_id", r("population", 6).alias("population"),
                      r("population_exposed", 6).alias("population_exposed"))
