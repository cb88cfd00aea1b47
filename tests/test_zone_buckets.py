import math
import random

from pyspark.sql import functions as F

from hexaccess.operators.zonal import MOST_EDGES, columns_of, point_in_zone, rows_of, zone_buckets

RING = "array<array<struct<x:double,y:double>>>"


def cast(x, y, rings):
    """Even-odd ray cast over all rings."""
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            n += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return n % 2 == 1


def star(cx, cy, r, n, rng):
    ring = [(cx + r * rng.uniform(0.7, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.7, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return ring + ring[:1]


def zones(spark, shapes):
    return spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in shapes], f"zone_id long, ring {RING}")


def test_split_buckets_are_the_ray_cast(spark):
    """Wiggly borders that lie in one bucket, holes, two zones over each other, and a small plain one."""
    rng = random.Random(4)
    shapes = [(1, [star(50, 50, 40, 600, rng), star(50, 50, 15, 200, rng)]), (2, [star(60, 45, 30, 300, rng)]),
              (3, [[(120, 20), (180, 20), (180, 80), (120, 80), (120, 20)]]), (3, [star(30, 130, 20, 150, rng)])]
    at = [(i, rng.uniform(0, 200), rng.uniform(0, 200)) for i in range(600)] + [(600 + i, rng.gauss(50, 25), rng.gauss(50, 25)) for i in range(600)]
    points = spark.createDataFrame(at, "pid long, x double, y double")
    for bucket in (100.0, 1000.0):
        got = sorted((r["pid"], r["zone_id"]) for r in point_in_zone(points, zones(spark, shapes), bucket, most=8).collect())
        assert got == sorted((i, z) for i, x, y in at for z, rings in shapes if cast(x, y, rings))


def test_border_of_100000_edges_in_one_bucket(spark):
    """No leaf holds more edges than it may, and the sides stay right."""
    n = 100_000
    rng = random.Random(7)
    ring = [(500 + 300 * (1 + 0.01 * rng.random()) * math.cos(2 * math.pi * i / n), 500 + 300 * (1 + 0.01 * rng.random()) * math.sin(2 * math.pi * i / n))
            for i in range(n)]
    zone = zones(spark, [(1, [ring + ring[:1]])])
    row = zone_buckets(zone, 1000.0).agg(F.max(F.size("_edges")).alias("most"), F.max("_lv").alias("deep"), F.count("*").alias("n")).first()
    assert row["most"] <= MOST_EDGES < 64 and 0 < row["deep"] < 12
    at = [(i, 500 + (290 + 0.02 * i) * math.cos(i), 500 + (290 + 0.02 * i) * math.sin(i)) for i in range(1000)]
    got = {r["pid"] for r in point_in_zone(spark.createDataFrame(at, "pid long, x double, y double"), zone, 1000.0).collect()}
    closed = [ring + ring[:1]]
    for i, x, y in at[::10]:
        assert (i in got) == cast(x, y, closed)
    assert all((i in got) == (290 + 0.02 * i < 300) for i, _, _ in at if not 295 < 290 + 0.02 * i < 304)


def test_border_edges_along_one_band_are_dealt_to_buckets(spark):
    """A coast of 20,000 edges within one latitude band: a border hexagon of the polyfill meets those of its own bucket."""
    n, b = 20_000, 0.05
    edges = spark.range(n).selectExpr("1 AS z", "0 AS _part", f"27 + 2.0 * id / {n} AS ax", "-4.02 + 0.01 * (id % 2) AS ay",
                                      f"27 + 2.0 * (id + 1) / {n} AS bx", "-4.02 + 0.01 * ((id + 1) % 2) AS by")
    dealt = columns_of(rows_of(edges, b), b).groupBy("_gx", "_gy").count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert dealt[0] <= 2.5 * n * b / 2 and dealt[1] <= 2 * n and dealt[2] >= 40


def test_polyfill_joins_border_hexagons_by_bucket(spark):
    from hexaccess.operators.grid import hex_polyfill
    ring = [(27.4, -4.2), (28.4, -4.25), (28.3, -3.8), (27.5, -3.7), (27.4, -4.2)]
    df = hex_polyfill(zones(spark, [(1, [ring])]).withColumnRenamed("zone_id", "admin_id"), 6, ring_col="ring")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 2 and all("_gx" in line and "_gy" in line and "_part" in line for line in joins)
