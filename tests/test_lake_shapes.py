"""Lake shapes (WKT): spread over tasks, and the staged projection and area against the plain ones."""

from pyspark.sql import functions as F

from hexaccess.functions import geo, polygon
from hexaccess.params import Params
from hexaccess.sources import derived


def test_one_small_file_is_spread_over_tasks(spark, tmp_path):
    """A part table in one file of one row group: the shapes are made, and so stored, by several tasks."""
    rows = spark.range(0, 60_000, 1, 1).selectExpr("id AS p_partkey", "concat('p', id) AS p_name", "'A' AS p_type")
    rows.write.parquet(str(tmp_path / "part.parquet"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        shapes = derived.lake_shapes_lonlat(spark, str(tmp_path), Params()).where("theme = 'buildings'")
        by_task = shapes.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", old)
    counts = [r["count"] for r in by_task]
    assert sum(counts) == 60_000 and len(counts) >= 3 and max(counts) < 30_000


def test_ring_projection_is_that_of_its_points(spark):
    ring = [{"x": 27.3 + 0.31 * i, "y": -4.5 + 0.17 * i} for i in range(7)] + [{"x": None, "y": 1.0}, {"x": 27.0, "y": 0.0}]
    df = spark.createDataFrame([(ring,), ([],), (None,)], "ring array<struct<x:double,y:double>>")
    got = [r[0] for r in df.select(geo.ring_to_utm(F.col("ring"))).collect()]
    points = df.limit(1).select(F.explode("ring").alias("p")).select(geo.to_utm(F.col("p.x"), F.col("p.y")).alias("u")).collect()
    assert got[0] == [p["u"] for p in points] and got[1:] == [[], None]


def test_each_term_of_a_projection_is_written_once(spark):
    """Lambdas are evaluated as written: the terms of a ring's projection stand in the plan once a use, not once a path."""
    df = spark.createDataFrame([([{"x": 27.0, "y": -4.0}],)], "ring array<struct<x:double,y:double>>")
    plan = df.select(geo.ring_to_utm(F.col("ring")).alias("u"))._jdf.queryExecution().analyzed().toString()
    assert plan.upper().count("ATAN2(") == 1 and plan.upper().count("ATANH(") == 3


def test_area_of_rings_and_wkt(spark):
    wkts = ["POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1), (4 4, 4 6, 6 6, 6 4, 4 4))", "POLYGON((0 0,4 0,4 4,0 0))",
            "SRID=4326;LINESTRING (1 2,  3 4)", "POLYGON EMPTY", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkts)], "i int, w string").select("i", geo.wkt_to_parts(F.col("w")).alias("parts"))
    area = F.transform("parts", polygon.rings_area)
    rows = {r["i"]: (r["a"], r["parts"]) for r in df.select("i", "parts", area.alias("a")).collect()}
    assert rows[0][0] == [95.0] and rows[1][0] == [8.0] and rows[3] == ([], []) and rows[4] == (None, None)
    assert [(p["x"], p["y"]) for p in rows[2][1][0][0]] == [(1.0, 2.0), (3.0, 4.0)]
