"""Summaries and rollups of the analysis grid (one-row or per-group aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess import fixed as FX
from hexaccess.functions import polygon


def population_totals(grid: DataFrame) -> DataFrame:
    """Total and exposed population, high-priority population and its share."""
    high = F.col("priority_class") == FX.PRIORITY_CLASSES[0]
    total = F.sum("population")
    high_pop = F.sum(F.when(high, F.col("population")).otherwise(F.lit(0.0)))
    return grid.agg(
        total.alias("total_population"),
        F.sum("population_exposed").alias("exposed_population"),
        high_pop.alias("high_priority_population"),
        (high_pop / F.when(total != 0, total) * F.lit(100.0)).alias("high_priority_pct"),
    )


def class_counts(grid: DataFrame, col: str = "priority_class") -> DataFrame:
    """Hexagon count per class (populated hexagons carry a class)."""
    return grid.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_hexes"))


def access_summary(grid: DataFrame, moderate_km: float = 10.0) -> DataFrame:
    """Mean nearest distance and the count strictly beyond ``moderate_km``."""
    d = F.col("nearest_facility_km")
    return grid.where(d.isNotNull()).agg(
        F.avg(d).alias("avg_distance_km"),
        F.count_if(d > F.lit(moderate_km)).alias("n_poor_access"),
        F.count(F.lit(1)).alias("n_hexes"),
    )


def run_summary(grid: DataFrame) -> DataFrame:
    """The one-row run summary (hexes, population, exposed, high hexes, mean km)."""
    return grid.agg(
        F.count(F.lit(1)).alias("total_hexes"),
        F.sum("population").alias("total_population"),
        F.sum("population_exposed").alias("exposed_population"),
        F.count_if(F.col("priority_class") == FX.PRIORITY_CLASSES[0]).alias("high_priority_hexes"),
        F.avg("nearest_facility_km").alias("avg_facility_distance_km"),
    )


def exposure_bins(grid: DataFrame) -> DataFrame:
    """Legend bins of exposed population: 0-10, 10-50, 50-100, 100-200, 200+."""
    e = F.col("population_exposed")
    *upper, (_, lowest) = FX.EXPOSURE_BINS
    b = F.lit(lowest)
    for edge, label in reversed(upper):
        b = F.when(e >= F.lit(edge), F.lit(label)).otherwise(b)
    return grid.where(F.col("population") > 0).groupBy(b.alias("exposure_bin")).agg(
        F.count(F.lit(1)).alias("n_hexes"))


def layer_extent(df: DataFrame, ring_col: str = "ring") -> DataFrame:
    """Extent (min/max x, y) of a polygon layer: per-row bbox, then a global min/max."""
    bb = polygon.ring_bbox(F.col(ring_col))
    return df.select(bb.alias("b")).agg(
        F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))


def admin_rollup(hex_admin: DataFrame, levels: tuple[str, ...] = ("NAME_0", "NAME_3")) -> DataFrame:
    """Admin rollup of hexagon results (hexagons already tagged with their
    admin unit): sums and population-weighted mean distance per level,
    with subtotals via ``rollup``."""
    pop = F.col("population")
    wd = F.when(F.col("nearest_facility_km").isNotNull(), pop * F.col("nearest_facility_km"))
    wp = F.when(F.col("nearest_facility_km").isNotNull(), pop)
    return hex_admin.rollup(*levels).agg(
        F.count(F.lit(1)).alias("n_hexes"),
        F.sum(pop).alias("population"),
        F.sum("population_exposed").alias("population_exposed"),
        (F.sum(wd) / F.when(F.sum(wp) != 0, F.sum(wp))).alias("weighted_distance_km"),
        F.count_if(F.col("priority_class") == FX.PRIORITY_CLASSES[0]).alias("high_priority_hexes"),
    )
