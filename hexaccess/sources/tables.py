"""Table, lake, GeoJSON and layered-file scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Attributes of any name; coordinates stay JSON text until the geometry's type is known.
GEOJSON_SCHEMA = (
    "type string, features array<struct<type:string, id:string, "
    "properties:map<string,string>, geometry:struct<type:string, coordinates:string>>>"
)


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over the session's tasks.  A small file of narrow rows is one task to Spark, however
    much is to be done with each row."""
    return df.withColumn("_nth", F.monotonically_increasing_id()).repartition("_nth").drop("_nth")


def scan_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               where: str | Column | None = None) -> DataFrame:
    """A stored analysis table, optionally projected and filtered.
    Both reach the Parquet scan (ReadSchema / PushedFilters)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def sql_query(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None,
              args: dict | None = None) -> DataFrame:
    """SQL text as the API, over named DataFrames registered as temp
    views; ``args`` binds named parameters (``:name``) safely."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args) if args else spark.sql(text)


def lake_scan(spark: SparkSession, base: str, themes: list[str] | None = None,
              bbox: tuple[float, float, float, float] | None = None, with_filename: bool = True) -> DataFrame:
    """S3: hive-partitioned Parquet lake (``theme=<t>/type=<k>/``) with
    partition discovery, the source file name as a column, and an optional
    bbox *containment* filter on the nested ``bbox`` struct (P2).  Theme
    selection prunes partitions; the bbox predicate is pushed to Parquet."""
    df = spark.read.option("basePath", base).parquet(base)
    if themes:
        df = df.where(F.col("theme").isin(list(themes)))
    if bbox is not None:
        df = df.where(bbox_contained(*bbox))
    return df.withColumn("filename", F.col("_metadata.file_path")) if with_filename else df


def bbox_contained(west: float, south: float, east: float, north: float, col: str = "bbox") -> Column:
    """Feature box fully inside the query box (not mere intersection)."""
    b = F.col(col)
    return ((b["xmin"] >= F.lit(west)) & (b["xmax"] <= F.lit(east))
            & (b["ymin"] >= F.lit(south)) & (b["ymax"] <= F.lit(north)))


def geojson_features(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """GeoJSON FeatureCollection documents -> one row per feature: id, name and
    amenity, ``properties`` (all attributes, as text), geometry type, and the
    geometry: lon/lat of a Point, ``points`` of a LineString, ``parts`` (rings
    of each part) of a Polygon or MultiPolygon.  Documents are one per line by
    default (as ``write_feature_collections`` writes them, many per file);
    ``multi_line=True`` reads one pretty-printed document per file."""
    docs = spark.read.schema(GEOJSON_SCHEMA).option("multiLine", multi_line).json(path)
    f = docs.select(F.explode("features").alias("f"))
    kind, raw = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    position = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    rings = lambda part: F.transform(part, lambda ring: F.transform(ring, position))
    point = F.when(kind == "Point", F.from_json(raw, "array<double>"))
    line = F.when(kind == "LineString", F.from_json(raw, "array<array<double>>"))
    polygon = F.when(kind == "Polygon", F.array(F.from_json(raw, "array<array<array<double>>>")))
    parts = F.when(kind == "MultiPolygon", F.from_json(raw, "array<array<array<array<double>>>>")).otherwise(polygon)
    return f.select(
        F.coalesce(F.col("f.properties")["id"], F.col("f.id")).alias("id"), F.col("f.properties")["name"].alias("name"),
        F.col("f.properties")["amenity"].alias("amenity"), F.col("f.properties").alias("properties"),
        kind.alias("geometry_type"), F.get(point, 0).alias("lon"), F.get(point, 1).alias("lat"),
        F.transform(line, position).alias("points"), F.transform(parts, rings).alias("parts"),
    )


def layer_scan(spark: SparkSession, path: str, layers: list[str] | tuple[str, ...]) -> DataFrame:
    """A layered vector store (Parquet partitioned by ``layer``): rows of
    the first layer in ``layers`` that exists, else the next one.  The
    choice is a scalar subquery (min preference rank present), so it stays
    one lazy plan and the partition filter prunes the other layers."""
    df = spark.read.parquet(path).where(F.col("layer").isin(list(layers)))
    rank = F.array_position(F.array(*[F.lit(x) for x in layers]), F.col("layer"))
    best = df.select(rank.alias("rk")).agg(F.min("rk")).scalar()
    return df.where(rank == best)


def bbox_points(df: DataFrame, west: float, south: float, east: float, north: float,
                lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Point features inside an extent (API ``extent=`` filter)."""
    return df.where(F.col(lon).between(west, east) & F.col(lat).between(south, north))
