"""Edge rows: rings (edge points, concave, holes, not closed), clipping,
raster nodata/NaN/outside cells, multi-part study areas."""

import math

import pytest
from pyspark.sql import functions as F

from hexaccess.functions import geo, polygon
from hexaccess.operators.grid import hex_polyfill, hex_polyfill_union
from hexaccess.operators.raster import raster_align, raster_clip_box, raster_valid
from hexaccess.operators.vector import clip_layer_to_box, repair, validate
from hexaccess.sources.raster import Raster, RasterMeta

RING = "array<struct<x:double,y:double>>"


def _ring(spark, pts):
    return spark.createDataFrame([(1, [{"x": float(x), "y": float(y)} for x, y in pts])], f"id int, ring {RING}")


def _inside(spark, pts, px, py):
    df = _ring(spark, pts)
    return df.select(polygon.point_in_ring(F.lit(px), F.lit(py), F.col("ring"))).first()[0]


CONCAVE = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]


def test_point_in_concave_ring(spark):
    assert _inside(spark, CONCAVE, 1, 1)
    assert _inside(spark, CONCAVE, 3, 1.5)
    assert not _inside(spark, CONCAVE, 2, 3)       # in the notch
    assert not _inside(spark, CONCAVE, 5, 1)


def test_polygon_with_hole(spark):
    outer = [{"x": x, "y": y} for x, y in [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    hole = [{"x": x, "y": y} for x, y in [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]]
    df = spark.createDataFrame([([outer, hole],)], f"rings array<{RING}>")
    got = [df.select(polygon.point_in_polygon(F.lit(px), F.lit(py), F.col("rings"))).first()[0]
           for px, py in [(1.0, 1.0), (5.0, 5.0), (11.0, 5.0)]]
    assert got == [True, False, False]


def test_point_on_edge_is_consistent_between_neighbours(spark):
    left = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    right = [(1, 0), (2, 0), (2, 1), (1, 1), (1, 0)]
    # a point on the shared edge belongs to exactly one of the two units
    assert _inside(spark, left, 1.0, 0.5) != _inside(spark, right, 1.0, 0.5)


def test_area_and_centroid_of_concave_ring(spark):
    df = _ring(spark, CONCAVE)
    r = df.select(polygon.polygon_area(F.col("ring")).alias("a"),
                  polygon.polygon_centroid(F.col("ring")).alias("c")).first()
    assert r.a == pytest.approx(10.0)          # 16 minus the notch triangle (6)
    assert 0 < r.c.x < 4 and 0 < r.c.y < 4


def test_validity_reasons(spark):
    rows = [(1, [(0, 0), (1, 0), (1, 1), (0, 1)]),                   # not closed
            (2, [(0, 0), (1, 0), (0, 0)]),                           # too few points
            (3, [(0, 0), (1, 0), (2, 0), (0, 0)]),                   # zero area
            (4, [(0, 0), (4, 4), (4, 0), (0, 2), (0, 0)]),           # uneven bow-tie
            (5, [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])]           # fine
    df = spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in p]) for i, p in rows],
                               f"id int, ring {RING}")
    got = {r.id: r.invalid_reason for r in validate(df).collect()}
    assert got == {1: "not_closed", 2: "too_few_points", 3: "zero_area", 4: "self_crossing", 5: None}


def test_repair_closes_dedups_and_orients(spark):
    pts = [(0, 1), (1, 1), (1, 1), (1, 0), (0, 0)]                   # clockwise, duplicate, open
    ok, rej = repair(_ring(spark, pts))
    assert rej.count() == 0
    ring = ok.first().ring
    assert (ring[0].x, ring[0].y) == (ring[-1].x, ring[-1].y)
    assert len(ring) == 5
    area = ok.select(polygon.signed_area(F.col("ring"))).first()[0]
    assert area == pytest.approx(1.0)


def test_clip_is_idempotent_and_exact_for_boxes(spark):
    df = _ring(spark, [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)])
    once = clip_layer_to_box(df, 2.0, 3.0, 5.0, 20.0)
    twice = clip_layer_to_box(once, 2.0, 3.0, 5.0, 20.0)
    a1 = once.select(polygon.polygon_area(F.col("ring"))).first()[0]
    a2 = twice.select(polygon.polygon_area(F.col("ring"))).first()[0]
    assert a1 == pytest.approx(21.0) and a2 == pytest.approx(a1)
    assert clip_layer_to_box(df, 20.0, 20.0, 30.0, 30.0).count() == 0


def test_raster_nodata_nan_and_outside_cells(spark):
    meta = RasterMeta.from_bounds(0.0, 0.0, 4.0, 4.0, 4, 4, "EPSG:4326", nodata=-9999.0)
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, -9999.0), (0, 2, float("nan")), (1, 1, None), (3, 3, 5.0)],
                                  "row bigint, col bigint, value double")
    r = Raster(cells, meta)
    assert sorted((x.row, x.col) for x in raster_valid(r).collect()) == [(0, 0), (3, 3)]
    other = Raster(spark.createDataFrame([(0, 0, 2.0)], "row bigint, col bigint, value double"),
                   RasterMeta.from_bounds(0.0, 2.0, 2.0, 4.0, 1, 1, "EPSG:4326"))
    got = {(x.row, x.col): x.other_value for x in raster_align(r, other).collect()}
    assert got == {(0, 0): 2.0, (3, 3): 0.0}                          # outside the other raster -> 0
    clipped = raster_clip_box(r, 0.0, 2.0, 2.0, 4.0)
    assert clipped.meta.n_rows == 2 and clipped.meta.n_cols == 2


def test_two_part_study_area_polyfill(spark):
    a = [(27.5, -4.0), (27.8, -4.0), (27.8, -3.8), (27.5, -3.8), (27.5, -4.0)]
    b = [(28.3, -4.2), (28.6, -4.2), (28.6, -3.9), (28.3, -3.9), (28.3, -4.2)]
    df = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in a]), (1, [{"x": x, "y": y} for x, y in b])],
                               f"admin_id int, ring {RING}")
    per_part = hex_polyfill(df, 7)
    union = hex_polyfill_union(df, 7)
    assert union.count() == per_part.select("hex_id").distinct().count() > 0
    cen = union.select("q", "r")
    assert cen.count() > 10


def test_tile_xy_known_values(spark):
    r = spark.createDataFrame([(0.0, 0.0, 1), (-180.0, 85.0, 2), (179.999, -85.0, 3)], "lon double, lat double, z int")
    got = [tuple(x) for x in r.select(geo.tile_xy(F.col("lon"), F.col("lat"), F.col("z")).alias("t")).select("t.x", "t.y").collect()]
    assert got == [(1, 1), (0, 0), (7, 7)]


def test_text_grid_reader(spark, tmp_path):
    from hexaccess.sources.raster import read_text_grid
    p = tmp_path / "grid.txt"
    p.write_text("0 1.5 2.5 3.5\n1 4.0 -9999 6.0\n")
    meta = RasterMeta.from_bounds(0.0, 0.0, 3.0, 2.0, 3, 2, "EPSG:4326", nodata=-9999.0)
    r = read_text_grid(spark, str(p), meta)
    got = sorted((x.row, x.col, x.value) for x in raster_valid(r).collect())
    assert got == [(0, 0, 1.5), (0, 1, 2.5), (0, 2, 3.5), (1, 0, 4.0), (1, 2, 6.0)]
