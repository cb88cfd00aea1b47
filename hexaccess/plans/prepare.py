"""Input preparation jobs (the ingest stage), from stored sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hexaccess.functions import geo, polygon
from hexaccess.operators.raster import raster_cell_xy, raster_clip_box
from hexaccess.operators.vector import clip_layer_to_box, first_n, repair
from hexaccess.params import Params
from hexaccess.sinks.writers import geojson_feature, write_feature_collections, write_table
from hexaccess.sources import derived
from hexaccess.sources.tables import bbox_points, geojson_features, lake_scan, layer_scan


def admin_prepare(spark: SparkSession, sf_dir: str, p: Params, box, scratch: str,
                  subset: bool = False) -> tuple[DataFrame, DataFrame]:
    """Admin layer (preferred layer name, else the alternative) ->
    overlay with the study box -> optional first unit -> UTM -> repair.
    Returns the accepted units and the rejected ones (with
    ``invalid_reason``); rings come out in the analysis CRS."""
    admin = derived.admin_lonlat(spark, sf_dir, p).withColumn("layer", F.lit(p.layers[1]))
    path = write_table(admin, scratch, partition_by=["layer"])
    a = layer_scan(spark, path, list(p.layers)).drop("layer")
    a = clip_layer_to_box(a, *box)
    if subset:
        a = first_n(a, 1, ["admin_id"])
    a = a.withColumn("ring", geo.ring_to_utm(F.col("ring"), p.utm_zone, p.south_hemisphere))
    return repair(a)


def population_prepare(spark: SparkSession, sf_dir: str, p: Params, box) -> DataFrame:
    """Clip the population raster to the box (cells whose centre is
    inside), crop the window and give each cell its UTM centre.  Counts
    are never resampled (totals are kept)."""
    pop = raster_clip_box(derived.pop_raster(spark, sf_dir, p), *box)
    cells = raster_cell_xy(pop)
    return geo.with_utm(cells, "x", "y", "ux", "uy", p.utm_zone, p.south_hemisphere).select(
        "row", "col", "value", F.col("ux").alias("x"), F.col("uy").alias("y"))


def facility_prepare(spark: SparkSession, sf_dir: str, p: Params, box, scratch: str,
                     subset: bool = False) -> DataFrame:
    """Facility GeoJSON documents -> features in the extent -> optional
    first 5 -> UTM."""
    f = derived.facilities_lonlat(spark, sf_dir, p)
    feat = f.select("id", geojson_feature(
        {"id": F.col("id").cast("string"), "name": F.col("name"), "amenity": F.col("amenity")},
        "Point", F.array("lon", "lat")).alias("feature"))
    path = write_feature_collections(feat, "feature", F.col("id"), scratch, per_doc=200)
    g = bbox_points(geojson_features(spark, path), *box).withColumn("id", F.col("id").cast("long"))
    if subset:
        g = first_n(g, 5, ["id"])
    return geo.with_utm(g, "lon", "lat", "x", "y", p.utm_zone, p.south_hemisphere).select(
        "id", "name", "amenity", "x", "y")


def lake_theme_prepare(spark: SparkSession, lake_path: str, p: Params, box, themes=None,
                       subset: bool = False) -> DataFrame:
    """Lake records of the themes, contained in the box, geometry in UTM: points
    (x, y), or, where the lake holds WKT text, shapes (see ``lake_shapes``)."""
    df = lake_scan(spark, lake_path, themes=themes, bbox=box)
    if subset:
        df = first_n(df, 100, ["id"])
    if isinstance(df.schema["geometry"].dataType, StringType):
        return lake_shapes(df, p)
    df = df.select("id", "theme", F.col("geometry.x").alias("lon"), F.col("geometry.y").alias("lat"))
    return geo.with_utm(df, "lon", "lat", "x", "y", p.utm_zone, p.south_hemisphere)


def lake_shapes(df: DataFrame, p: Params) -> DataFrame:
    """(id, theme, geometry_type, parts, area_m2, length_m) of records whose ``geometry`` is WKT (buildings,
    road segments, places): every part and ring projected; areas without holes, lengths of lines."""
    kind = F.upper(F.regexp_extract("geometry", r"^(?:SRID=\d+;)?\s*([A-Za-z]+)", 1))
    utm = lambda ring: geo.ring_to_utm(ring, p.utm_zone, p.south_hemisphere)
    shapes = df.select("id", "theme", kind.alias("geometry_type"),
                       F.transform(geo.wkt_to_parts(F.col("geometry")), lambda part: F.transform(part, utm)).alias("parts"))
    total = lambda of: F.aggregate(F.transform("parts", of), F.lit(0.0), lambda t, v: t + v)
    return shapes.withColumn("area_m2", F.when(F.col("geometry_type").endswith("POLYGON"), total(polygon.rings_area))).withColumn(
        "length_m", F.when(F.col("geometry_type") == "LINESTRING", total(lambda part: geo.line_length(F.get(part, 0)))))
