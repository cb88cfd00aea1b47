"""hexaccess: hazard exposure and service access analytics as Spark jobs.

Geometry, projection, hexagon and raster maths are Spark Column
expressions; zonal sums, nearest-facility search and scoring are
DataFrame joins and aggregations.  Nothing on the core path is a
Python UDF.
"""

from hexaccess.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
