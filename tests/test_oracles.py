"""Every registered query against its DuckDB oracle at sf0.001 (a sample
of keys here; tools/oracle_check.py runs them all)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare

KEYS = ["hazard_pipeline", "exposure", "nearest_facility", "knn_facilities", "zonal_polygon", "raster_bilinear",
        "geom_repair", "admin_rollup", "tile_thin", "network_distance", "score_percentiles", "lake_scan",
        "exposure_stream", "hex_polyfill", "raster_clip_zones", "raster_pyramid", "raster_overview",
        "update_unmatched", "null_repair_cases"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    line, ok = compare(spark, SF_SMALL, key, entry.queries()[key], entry.oracle_sql()[key])
    assert ok, line
