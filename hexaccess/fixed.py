"""Values that must equal the reference's for identical results.

Kept together, in the order the analysis uses them.  Tunable study
parameters (box, level, thresholds, weights, percentile) live in
``params.Params``; these are the constants of the formulas and views.
"""

# Accessibility score, piecewise linear in distance d (km)
#   d < threshold:  1.0 - (d / threshold) * 0.5
#   d < moderate:   0.5 - ((d - threshold) / (moderate - threshold)) * 0.3
#   otherwise:      max(0.2 - (d - moderate) * 0.01, 0.0)
SCORE_TOP = 1.0
SCORE_GOOD_SPAN = 0.5
SCORE_AT_THRESHOLD = 0.5
SCORE_MODERATE_SPAN = 0.3
SCORE_AT_MODERATE = 0.2
SCORE_POOR_SLOPE_PER_KM = 0.01
SCORE_FLOOR = 0.0

# Class labels
ACCESS_CLASSES = ("good", "moderate", "poor")
PRIORITY_CLASSES = ("high", "medium", "low")
PRIORITY_MID_PERCENTILE = 50.0

# Exposure percent and the legend bins of exposed population
PERCENT_SCALE = 100.0
EXPOSURE_BINS = ((200.0, "200+"), (100.0, "100-200"), (50.0, "50-100"), (10.0, "10-50"), (0.0, "0-10"))

# Popup defaults
MISSING_CLASS = "N/A"
MISSING_NAME = "Unnamed"
MISSING_TYPE = "Health facility"

# Admin layer names, tried in this order
ADMIN_LAYERS = ("ADM_ADM_3", "gadm41_COD_3")
