"""Rasters as long tables.

A raster is a DataFrame of cells ``(row bigint, col bigint, value double)``
plus a tiny ``RasterMeta`` (the header: origin, cell size, shape, CRS,
nodata).  Row 0 is the northern edge.  At scale the cell table is stored
as Parquet partitioned by block row so clips and alignments prune files.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_SCHEMA = "row bigint, col bigint, value double"
FILE_EDGE = 512     # cells along a stored file's edge where blocks are smaller


def blocks_a_file(block: int) -> int:
    """Blocks along the edge of a stored file."""
    return max(1, FILE_EDGE // int(block))


@dataclass(frozen=True)
class RasterMeta:
    x0: float          # west edge
    y0: float          # north edge
    dx: float          # cell width
    dy: float          # cell height (positive; rows grow southwards)
    n_rows: int
    n_cols: int
    crs: str = "EPSG:4326"
    nodata: float | None = None
    block: int = 512   # storage block edge in cells (cell tables are partitioned by row // block, col // block)

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return (self.x0, self.y0 - self.n_rows * self.dy, self.x0 + self.n_cols * self.dx, self.y0)

    def with_shape(self, **kw) -> "RasterMeta":
        return replace(self, **kw)

    @staticmethod
    def from_bounds(west, south, east, north, n_cols, n_rows, crs="EPSG:4326", nodata=None):
        return RasterMeta(west, north, (east - west) / n_cols, (north - south) / n_rows,
                          int(n_rows), int(n_cols), crs, nodata)


@dataclass(frozen=True)
class Raster:
    cells: DataFrame
    meta: RasterMeta


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cell_center_x(col, meta: RasterMeta) -> Column:
    """x of the centre of column ``col``: x0 + (col + 0.5) * dx."""
    return F.lit(meta.x0) + (_col(col).cast("double") + F.lit(0.5)) * F.lit(meta.dx)


def cell_center_y(row, meta: RasterMeta) -> Column:
    """y of the centre of row ``row``: y0 - (row + 0.5) * dy (row 0 is north)."""
    return F.lit(meta.y0) - (_col(row).cast("double") + F.lit(0.5)) * F.lit(meta.dy)


def cell_of_x(x: Column, meta: RasterMeta) -> Column:
    """Column index of the cell containing planar x (may be out of range)."""
    return F.floor((x - F.lit(meta.x0)) / F.lit(meta.dx))


def cell_of_y(y: Column, meta: RasterMeta) -> Column:
    return F.floor((F.lit(meta.y0) - y) / F.lit(meta.dy))


def read_overview(spark: SparkSession, path: str, cell: float | None = None, level: int | None = None) -> Raster:
    """A level of a raster stored with its overviews (``operators.raster.write_pyramid``): ``level``, or the coarsest
    whose cells are no wider than ``cell`` (full resolution if none is).  Only that level's blocks are read."""
    if (cell is None) == (level is None):
        raise ValueError("name either a cell width or a level")
    headers = spark.read.parquet(f"{path}/_overviews/_levels")
    fits = headers.where(F.col("level") == level if cell is None else (F.col("dx") <= F.lit(float(cell))) | (F.col("level") == 0))
    best = fits.orderBy(F.col("level").desc()).first()
    if best is None:
        raise ValueError(f"no level {level} in {path}")
    header = best.asDict()
    number = header.pop("level")
    return read_raster(spark, f"{path}/_overviews/{number}" if number else path, RasterMeta(**header))


def read_raster(spark: SparkSession, path: str, meta: RasterMeta | None = None) -> Raster:
    """Scan a stored cell table, by default with the header stored beside it.  The columns of blocks (``tile_row``, ``tile_col``) and of
    files (the partition columns ``tile_row_group``, ``tile_col_group``), written by ``sinks.writers.write_raster``,
    are kept so window filters can prune whole files."""
    if meta is None:
        meta = RasterMeta(**spark.read.parquet(f"{path}/_header").first().asDict())
    df = spark.read.parquet(path)
    cols = ["row", "col", "value"] + [c for c in ("tile_row", "tile_col", "tile_row_group", "tile_col_group") if c in df.columns]
    return Raster(df.select(*cols), meta)


def read_text_grid(spark: SparkSession, path: str, meta: RasterMeta) -> Raster:
    """Scan a whitespace-separated text grid (one raster row per line,
    with the row number as the first field), e.g. an exported ASCII grid."""
    lines = spark.read.text(path)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    cells = (
        lines.select(F.get(parts, 0).cast("long").alias("row"),
                     F.slice(parts, 2, meta.n_cols).alias("vals"))
        .select("row", F.posexplode("vals").alias("col", "v"))
        .select("row", F.col("col").cast("long").alias("col"), F.col("v").cast("double").alias("value"))
    )
    return Raster(cells, meta)
