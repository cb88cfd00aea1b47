"""A run's outputs: tables with bounding boxes, rasters with headers, tile tables, GeoJSON, and the manifest."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.functions import geo, polygon
from hexaccess.operators.edges import as_rings
from hexaccess.params import Params
from hexaccess.sinks.writers import geojson_feature, ring_coordinates, write_geojson_lines, write_table
from hexaccess.sources.raster import Raster

PARQUET, GEOJSON = "application/vnd.apache.parquet", "application/geo+json-seq"
#: What a hexagon's tile feature carries.
HEX_TILE_ATTRIBUTES = ["population", "population_exposed", "exposure_pct", "nearest_facility_km", "accessibility_class",
                       "accessibility_score", "priority_score", "priority_class"]


def with_bbox(df: DataFrame, ring_col: str) -> DataFrame:
    """``df`` with a ``bbox`` struct of its polygons, so that stored layers prune by box."""
    rings = as_rings(df, ring_col)
    return df.withColumn("bbox", polygon.ring_bbox(F.get(rings, 0)))


def point_bbox(x: Column, y: Column) -> Column:
    return F.struct(x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax"))


def tile_layers(grid: DataFrame, facilities: DataFrame, p: Params) -> dict[str, DataFrame]:
    """Feature rows keyed by (zoom, tile_x, tile_y): populated hexagons with their attributes, and facilities.
    ``grid`` and ``facilities`` (lon, lat) are in lon/lat."""
    from hexaccess.operators.tiles import tile_features
    zooms = range(p.min_zoom, p.max_zoom + 1)
    hexes = tile_features(grid.where("population > 0"), zooms, ring="geometry", keep=HEX_TILE_ATTRIBUTES)
    zoomed = facilities.select("id", "name", "amenity", "lon", "lat", F.explode(F.array(*[F.lit(z) for z in zooms])).alias("zoom"))
    t = geo.tile_xy(F.col("lon"), F.col("lat"), F.col("zoom"))
    points = zoomed.select("id", "name", "amenity", "lon", "lat", "zoom", t["x"].alias("tile_x"), t["y"].alias("tile_y"))
    return {"hexagon_tiles": hexes, "facility_tiles": points}


def manifest(spark: SparkSession, assets: dict[str, tuple[str, str]], p: Params, created: str) -> DataFrame:
    """One row per asset (name -> (path, media type)): path, rows, lon/lat extent of its ``bbox`` column where it
    has one, media type, run time, and the run's parameters as JSON.  Each asset is counted from what was written."""
    rows = None
    for name, (path, media) in assets.items():
        df = spark.read.parquet(path) if media == PARQUET else spark.read.text(path)
        box = F.col("bbox") if "bbox" in df.columns else F.lit(None).cast("struct<xmin:double,ymin:double,xmax:double,ymax:double>")
        one = df.select(box.alias("b")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
            F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax")).select(
            F.lit(name).alias("asset"), F.lit(path).alias("path"), "*", F.lit(media).alias("media_type"),
            F.lit(created).alias("created"), F.lit(json.dumps(asdict(p), sort_keys=True)).alias("study"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def write_outputs(outs: dict[str, DataFrame], population, flood, p: Params, base: str, created: str,
                  mode: str = "overwrite") -> DataFrame:
    """Write everything a run makes under ``base`` and return (and write) its manifest.

    ``outs`` is what ``jobs.pipeline_from_inputs`` returns.  Grid, admin and
    facility layers are stored in lon/lat with bounding boxes; both input rasters
    and the exposed population as blocks with headers and overview levels (averages;
    nearest for the hazard, whose depths must not blend), each level an asset.
    """
    from hexaccess.functions import scoring
    from hexaccess.operators.raster import write_pyramid
    from hexaccess.plans import jobs
    spark, base = outs["grid"].sparkSession, base.rstrip("/")
    zone, south = p.utm_zone, p.south_hemisphere
    grid = with_bbox(jobs.to_lonlat_grid(outs["grid"], p), "geometry")
    facilities = geo.with_lonlat(outs["facilities"], "x", "y", "lon", "lat", zone, south)
    admin = outs["admin"]
    tables = {"grid": grid, "admin": with_bbox(admin, "rings" if "rings" in admin.columns else "ring"),
              "facilities": facilities.withColumn("bbox", point_bbox(F.col("lon"), F.col("lat")))}
    tables |= {k: v for k, v in outs.items() if k not in tables}
    assets = {name: (write_table(df, f"{base}/{name}", mode=mode, compression=p.compression), PARQUET) for name, df in tables.items()}
    stored = spark.read.parquet(f"{base}/grid")
    for name, df in tile_layers(stored, facilities, p).items():
        assets[name] = (write_table(df, f"{base}/{name}", mode=mode, compression=p.compression, partition_by=["zoom"]), PARQUET)
    exposed = jobs.exposure_cells(population, flood, p).select(
        "row", "col", scoring.flood_mask(F.col("depth"), F.col("value")).alias("value"))
    rasters = {"population_raster": (population, "avg"), "hazard_raster": (flood, "nearest"),
               "exposed_population": (Raster(exposed, population.meta), "avg")}
    for name, (raster, how) in rasters.items():
        for level, path in write_pyramid(raster, f"{base}/{name}", how=how, block=p.block_size, mode=mode).items():
            assets[f"{name}_overview_{level}" if level else name] = (path, PARQUET)
    features = stored.where("population > 0").select(geojson_feature(
        {c: F.col(c) for c in ["hex_id", *HEX_TILE_ATTRIBUTES]}, "Polygon", ring_coordinates(F.col("geometry"))).alias("f"))
    assets["hexagons_geojson"] = (write_geojson_lines(features, "f", f"{base}/hexagons_geojson", mode=mode), GEOJSON)
    write_table(manifest(spark, assets, p, created).coalesce(1), f"{base}/manifest", mode=mode)
    return spark.read.parquet(f"{base}/manifest")
