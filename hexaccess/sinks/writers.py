"""Sinks: Parquet tables, line-delimited GeoJSON, FeatureCollection
documents, raster cell tables and the output manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexaccess.sources.raster import blocks_a_file

HEADER_SCHEMA = ("x0 double, y0 double, dx double, dy double, n_rows int, n_cols int, crs string, "
                 "nodata double, block int")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "zstd",
                partition_by: list[str] | None = None) -> str:
    """K1/K3/K5: replace (or, with ``mode="ignore"``, keep -- K2) a table.
    Partitions are written in parallel by the executors."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_tables(tables: dict[str, DataFrame | None], base: str, mode: str = "overwrite") -> dict[str, str]:
    """K1: load several datasets in a loop; missing (None) ones are skipped."""
    out = {}
    for name, df in tables.items():
        if df is None:
            continue
        out[name] = write_table(df, f"{base.rstrip('/')}/{name}", mode=mode)
    return out


def geojson_feature(properties: dict[str, Column], geometry_type: str, coordinates: Column) -> Column:
    """One GeoJSON Feature as a struct (serialise with ``to_json``)."""
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"),
        F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )


def ring_coordinates(ring: Column) -> Column:
    """GeoJSON polygon coordinates ``[[[x, y], ...]]`` from one ring."""
    return F.array(F.transform(ring, lambda p: F.array(p["x"], p["y"])))


def write_geojson_lines(features: DataFrame, feature_col: str, path: str, mode: str = "overwrite") -> str:
    """K6: one GeoJSON Feature per line (GeoJSONSeq); written in parallel."""
    features.select(F.to_json(F.col(feature_col)).alias("value")).write.mode(mode).text(path)
    return path


def write_feature_collections(features: DataFrame, feature_col: str, key: Column, path: str,
                              per_doc: int = 10000, mode: str = "overwrite") -> str:
    """FeatureCollection documents of at most ``per_doc`` features each
    (grouped by ``floor(key / per_doc)``), so no document -- and no task --
    has to hold a whole layer."""
    docs = (features.groupBy(F.floor(key / F.lit(per_doc)).alias("_doc"))
            .agg(F.collect_list(F.col(feature_col)).alias("features"))
            .select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")))
    docs.write.mode(mode).text(path)
    return path


def write_raster(cells: DataFrame, path: str, block: int = 512, mode: str = "overwrite", meta=None,
                 more: list[str] | None = None) -> str:
    """K7: raster cells stored by block (``tile_row``, ``tile_col``: ``row // block``,
    ``col // block``; the header's ``block``).  Blocks of ``FILE_EDGE`` cells or more are a file each; smaller ones
    share files of about FILE_EDGE x FILE_EDGE cells, in order, so files grow with the cells and not with the
    blocks.  Cells are dealt by file before the write (``tile_row_group``, ``tile_col_group``, the partition
    columns), so a clip or window reads only its own files, and within them only pages of its blocks.
    ``meta`` (the header) is stored with them for ``read_raster``; ``more`` names further columns to keep."""
    blocks = [F.floor(F.col(c) / F.lit(block)).cast("int").alias(f"tile_{c}") for c in ("row", "col")]
    groups = [F.floor(F.col(f"tile_{c}") / F.lit(blocks_a_file(block))).cast("int").alias(f"tile_{c}_group") for c in ("row", "col")]
    files = ["tile_row_group", "tile_col_group"]
    (cells.select("row", "col", "value", *(more or []), *blocks).select("*", *groups).repartition(*files)
     .sortWithinPartitions(*files, "tile_row", "tile_col")
     .write.mode(mode).option("compression", "zstd").partitionBy(*files).parquet(path))
    if meta is not None:   # a one-row table beside the cells, in a folder that scans of ``path`` pass over
        fields = dict(vars(meta), block=block)
        cells.sparkSession.createDataFrame([tuple(fields.values())], HEADER_SCHEMA).write.mode(mode).parquet(f"{path}/_header")
    return path
