"""Tile-keyed feature tables (the data behind a vector tile pyramid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess.functions import geo, polygon
from hexaccess.operators.topk import top_k_per_group


def tile_features(features: DataFrame, zooms: range | list[int], ring: str = "ring",
                  feature_id: str = "hex_id", keep: list[str] | None = None) -> DataFrame:
    """One row per (zoom, tile_x, tile_y, feature) for every tile a feature's
    lon/lat bounding box touches.  Tiles of a row are exploded in two steps
    (zoom x tile-column, then tile-rows) so a large feature spreads out."""
    keep = keep or []
    bb = polygon.ring_bbox(F.col(ring))
    z = F.explode(F.array(*[F.lit(int(v)) for v in zooms])).alias("zoom")
    base = features.select(feature_id, *keep, bb.alias("_bb")).select("*", z)
    lo = geo.tile_xy(F.col("_bb.xmin"), F.col("_bb.ymax"), F.col("zoom"))   # north-west corner
    hi = geo.tile_xy(F.col("_bb.xmax"), F.col("_bb.ymin"), F.col("zoom"))   # south-east corner
    cols = base.select(feature_id, *keep, "zoom", lo.alias("_lo"), hi.alias("_hi")).select(
        feature_id, *keep, "zoom", "_lo", "_hi",
        F.explode(F.sequence(F.col("_lo.x"), F.col("_hi.x"))).alias("tile_x"))
    return cols.select(feature_id, *keep, "zoom", "tile_x",
                       F.explode(F.sequence(F.col("_lo.y"), F.col("_hi.y"))).alias("tile_y"))


def tile_thin(tiles: DataFrame, cap: int, order: list, feature_id: str = "hex_id",
              salts: int = 16) -> DataFrame:
    """Keep at most ``cap`` features per tile, best first by ``order``
    (then feature id), with the two-phase top-k of ``topk`` so a dense
    low-zoom tile never has to be sorted in one task whole.  ``n_dropped``
    says how many features the tile lost."""
    keys = ["zoom", "tile_x", "tile_y"]
    kept = top_k_per_group(tiles, keys, cap, order, feature_id, rank_col="tile_rank", salts=salts)
    lost = tiles.groupBy(*keys).agg(F.greatest(F.count(F.lit(1)) - cap, F.lit(0)).alias("n_dropped"))
    return kept.join(lost, keys)
