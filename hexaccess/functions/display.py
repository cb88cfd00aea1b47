"""Popup views: rounded numbers, percent text and defaults for missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess import fixed as FX


def _value(c: str):
    """The number, 0 where it is missing or not a number."""
    return F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))


def _num(c: str, digits: int):
    return F.format_string(f"%.{digits}f", _value(c))


def _text(c: str, default: str):
    """The text, the default where it is missing or empty."""
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default))


def hex_popup(grid: DataFrame) -> DataFrame:
    """Hexagon popup fields; missing numbers show 0, missing classes 'N/A'."""
    return grid.select(
        "hex_id",
        F.format_string("%d", F.round(_value("population")).cast("long")).alias("population_text"),
        F.concat(F.format_string("%d", F.round(_value("population_exposed")).cast("long")),
                 F.lit(" ("), _num("exposure_pct", 1), F.lit("%)")).alias("exposed_text"),
        F.concat(_num("nearest_facility_km", 2), F.lit(" km")).alias("facility_text"),
        _text("accessibility_class", FX.MISSING_CLASS).alias("accessibility_text"),
        F.concat(_text("priority_class", FX.MISSING_CLASS), F.lit(" ("), _num("priority_score", 3),
                 F.lit(")")).alias("priority_text"),
    )


def facility_popup(facilities: DataFrame) -> DataFrame:
    """Facility popup fields; missing name 'Unnamed', missing type 'Health facility'."""
    return facilities.select(
        "id",
        _text("name", FX.MISSING_NAME).alias("name_text"),
        _text("amenity", FX.MISSING_TYPE).alias("type_text"),
    )
