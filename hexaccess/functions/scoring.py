"""Exposure, accessibility and priority formulas as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexaccess import fixed as FX
from hexaccess.functions.geo import _c


def flood_mask(depth, pop) -> Column:
    """Population counted as exposed where depth is strictly positive."""
    return F.when(_c(depth) > 0, _c(pop)).otherwise(F.lit(0.0))


def exposure_pct(exposed, pop) -> Column:
    """exposed / pop * 100 with a 0 population read as 1 (so 0 %), NaN -> 0."""
    pop = _c(pop)
    divisor = F.when(pop == 0, F.lit(1.0)).otherwise(pop)
    pct = _c(exposed) / divisor * F.lit(FX.PERCENT_SCALE)
    return F.coalesce(F.nanvl(pct, F.lit(0.0)), F.lit(0.0))


def access_class(d_km, threshold_km: float = 5.0, moderate_km: float = 10.0) -> Column:
    d = _c(d_km)
    good, moderate, poor = FX.ACCESS_CLASSES
    return (
        F.when(d.isNull(), F.lit(None).cast("string"))
        .when(d < F.lit(threshold_km), F.lit(good))
        .when(d < F.lit(moderate_km), F.lit(moderate))
        .otherwise(F.lit(poor))
    )


def access_score(d_km, threshold_km: float = 5.0, moderate_km: float = 10.0) -> Column:
    """Piecewise linear: 1 -> 0.5 over [0, t), 0.5 -> 0.2 over [t, m),
    then 0.2 minus 0.01 per km beyond m, floored at 0."""
    d = _c(d_km)
    t, m = F.lit(threshold_km), F.lit(moderate_km)
    return (
        F.when(d.isNull(), F.lit(None).cast("double"))
        .when(d < t, F.lit(FX.SCORE_TOP) - (d / t) * F.lit(FX.SCORE_GOOD_SPAN))
        .when(d < m, F.lit(FX.SCORE_AT_THRESHOLD) - ((d - t) / (m - t)) * F.lit(FX.SCORE_MODERATE_SPAN))
        .otherwise(F.greatest(F.lit(FX.SCORE_AT_MODERATE) - (d - m) * F.lit(FX.SCORE_POOR_SLOPE_PER_KM),
                              F.lit(FX.SCORE_FLOOR)))
    )


def minmax_scale(v, vmin, vmax) -> Column:
    """(v - min) / (max - min); every value 0 when max == min."""
    v, lo, hi = _c(v), _c(vmin), _c(vmax)
    return F.when(hi > lo, (v - lo) / F.when(hi > lo, hi - lo)).otherwise(F.lit(0.0))


def inaccessibility(score) -> Column:
    """1 - score; a missing score (NULL or NaN) counts as 0."""
    return F.lit(1.0) - F.coalesce(F.nanvl(_c(score), F.lit(0.0)), F.lit(0.0))


def priority_score(exposure_score, access_score_col, exposure_weight: float = 0.6,
                   accessibility_weight: float = 0.4) -> Column:
    return (_c(exposure_score) * F.lit(exposure_weight)
            + inaccessibility(access_score_col) * F.lit(accessibility_weight))


def priority_class(score, p_high, p_mid) -> Column:
    s = _c(score)
    high, medium, low = FX.PRIORITY_CLASSES
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s >= _c(p_high), F.lit(high))
        .when(s >= _c(p_mid), F.lit(medium))
        .otherwise(F.lit(low))
    )
