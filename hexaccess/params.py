"""Run parameters (the study configuration) as a frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field

from hexaccess.fixed import ADMIN_LAYERS


@dataclass(frozen=True)
class Params:
    # Study box in lon/lat degrees (west, south, east, north).
    west: float = 27.3
    south: float = -4.5
    east: float = 29.1
    north: float = -3.5
    study_name: str = "study area"      # shown in the manifest
    country_code: str = "COD"
    analysis_crs: str = "EPSG:32735"
    resolution: int = 6
    threshold_km: float = 5.0
    moderate_km: float = 10.0
    exposure_weight: float = 0.6
    accessibility_weight: float = 0.4
    top_percentile: float = 10.0
    compression: str = "zstd"
    # Tile pyramid used by the tile-keyed feature tables.
    min_zoom: int = 6
    max_zoom: int = 14
    max_features_per_tile: int = 200
    # Raster storage block edge in cells.
    block_size: int = 512
    layers: tuple[str, ...] = field(default=ADMIN_LAYERS)

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        return (self.west, self.south, self.east, self.north)

    @property
    def utm_zone(self) -> int:
        return int(self.analysis_crs.split(":")[1]) % 100

    @property
    def south_hemisphere(self) -> bool:
        return int(self.analysis_crs.split(":")[1]) // 100 == 327


DEFAULT = Params()
