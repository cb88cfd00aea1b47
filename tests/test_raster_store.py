"""Rasters clipped by many polygons at once, and rasters stored with overview levels."""

import random

import pytest
from pyspark.sql import functions as F

from hexaccess.operators.raster import pyramid_levels, raster_clip_box, raster_clip_zones, raster_overviews, write_pyramid, zone_windows
from hexaccess.plans import jobs
from hexaccess.sources.raster import Raster, RasterMeta, read_overview, read_raster
from tests.conftest import SF_SMALL

RINGS = "zone_id string, rings array<array<struct<x:double,y:double>>>"


def grid(spark, rows, cols, block=4):
    meta = RasterMeta(0.0, float(rows), 1.0, 1.0, rows, cols, block=block)
    return Raster(spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"),
                                                  F.col("id").cast("double").alias("value")), meta)


def inside(x, y, rings):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                n += 1
    return n % 2 == 1


def closed(*points):
    return [*points, points[0]]


def test_clip_by_many_polygons(spark):
    rng = random.Random(5)
    square = lambda x, y, s: closed((x, y), (x + s, y), (x + s, y + s), (x, y + s))
    zones = [("hole", [square(1.0, 1.0, 9.0), square(3.0, 3.0, 3.0)]),
             ("centres", [square(2.5, 2.5, 4.0)]),                                  # edges run through cell centres
             ("notch", [closed((0.0, 0.0), (12.0, 0.0), (12.0, 12.0), (6.0, 1.2), (0.0, 12.0))]),
             ("parts", [square(0.0, 0.0, 3.0)]), ("parts", [square(2.0, 2.0, 4.0)]), ("parts", [square(20.0, 1.0, 2.0)]),   # two overlap
             ("outside", [square(100.0, 100.0, 5.0)]), ("beyond", [square(-5.0, -5.0, 60.0)]), ("thin", [square(0.6, 0.6, 0.3)])]
    star = [(15 + (3 + 9 * rng.random()) * c, 7 + (2 + 5 * rng.random()) * s) for c, s in
            [(__import__("math").cos(k / 30 * 6.283), __import__("math").sin(k / 30 * 6.283)) for k in range(30)]]
    zones.append(("star", [closed(*star)]))
    r = grid(spark, 14, 31)
    df = spark.createDataFrame([(z, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for z, rings in zones], RINGS)
    got = sorted((x["zone_id"], x["row"], x["col"], x["value"]) for x in raster_clip_zones(r, df, "zone_id", "rings").collect())
    want = sorted({(z, i, j, float(i * 31 + j)) for z, rings in zones for i in range(14) for j in range(31)
                   if inside(j + 0.5, 14 - (i + 0.5), rings)})
    assert got == want
    windows = {w["zone_id"]: tuple(w)[1:] for w in zone_windows(df, r.meta, "zone_id", "rings").collect()}
    assert windows["hole"] == (4, 1, 9, 9) and windows["beyond"] == (0, 0, 14, 31) and windows["thin"][2:] == (0, 0)
    for z, i, j, _ in got:
        r0, c0, n, m = windows[z]
        assert r0 <= i < r0 + n and c0 <= j < c0 + m


def test_clip_by_a_box_is_the_box_clip(spark):
    pop = jobs.load_inputs(spark, SF_SMALL).population
    w, s, e, n = 27.5, -4.0, 28.0, -3.5
    ring = [{"x": x, "y": y} for x, y in [(w, s), (e, s), (e, n), (w, n), (w, s)]]
    zone = spark.createDataFrame([("z", [ring])], RINGS)
    cells = raster_clip_zones(pop, zone, "zone_id", "rings").join(zone_windows(zone, pop.meta, "zone_id", "rings"), "zone_id")
    a = sorted(map(tuple, cells.select(F.col("row") - F.col("row0"), F.col("col") - F.col("col0"), "value").collect()))
    b = sorted(map(tuple, raster_clip_box(pop, w, s, e, n).cells.select("row", "col", "value").collect()))
    assert a == b and len(a) > 0
    assert raster_clip_zones(pop, zone.limit(0), "zone_id", "rings").count() == 0


@pytest.mark.parametrize("how", ["avg", "nearest"])
def test_pyramid_is_stored_level_by_level(spark, tmp_path, how):
    r = grid(spark, 37, 21, block=8)
    holes = Raster(r.cells.where("value % 7 <> 3").withColumn("value", F.when(F.col("value") % 11 == 0, float("nan")).otherwise(F.col("value"))),
                   r.meta.with_shape(nodata=5.0))
    path = str(tmp_path / "p")
    assert pyramid_levels(r.meta, 8) == 3
    paths = write_pyramid(holes, path, how=how)
    assert sorted(paths) == [0, 1, 2, 3]
    want = raster_overviews(holes, 3, how)
    for level in (1, 2, 3):
        got = read_overview(spark, path, level=level)
        assert got.meta == holes.meta.with_shape(dx=2.0 ** level, dy=2.0 ** level, n_rows=-(-37 // 2 ** level), n_cols=-(-21 // 2 ** level), nodata=None)
        rows = lambda d: {(x["row"], x["col"]): x["value"] for x in d.select("row", "col", "value").collect()}
        assert rows(got.cells) == pytest.approx(rows(want[level]))
        assert "tile_row" in got.cells.columns
    assert read_raster(spark, path).cells.count() == holes.cells.count()      # scans of the raster pass over its overviews
    assert read_overview(spark, path, cell=5.0).meta.dx == 4.0 and read_overview(spark, path, cell=0.1).meta.dx == 1.0
    assert read_overview(spark, path, cell=1e9).meta.dx == 8.0
    with pytest.raises(ValueError):
        read_overview(spark, path, level=9)


def test_files_grow_with_the_cells_and_not_with_the_blocks(spark, tmp_path):
    """300 x 300 cells in 5,625 blocks: one file a level, the blocks in order within it, clips as before."""
    import glob
    r = grid(spark, 300, 300, block=4)
    path = str(tmp_path / "p")
    for level, stored in write_pyramid(r, path, levels=2, how="nearest").items():
        assert len(glob.glob(f"{stored}/tile_*/**/*.parquet", recursive=True)) == 1
        cells = read_overview(spark, path, level=level).cells
        assert cells.where("tile_row <> floor(row / 4) OR tile_col <> floor(col / 4)").count() == 0
        assert cells.select("tile_row", "tile_col").distinct().count() == (-(-300 // 2 ** level // 4)) ** 2
    far = grid(spark, 600, 1100, block=256)
    write_pyramid(far, str(tmp_path / "far"), levels=0)
    stored = read_raster(spark, str(tmp_path / "far"))
    clipped = raster_clip_box(stored, 505.0, 80.0, 520.0, 95.0)
    assert len(clipped.cells.inputFiles()) >= 4 and stored.cells.select("tile_row_group", "tile_col_group").distinct().count() == 6
    rows = lambda c: sorted(map(tuple, c.cells.select("row", "col", "value").collect()))
    assert rows(clipped) == rows(raster_clip_box(far, 505.0, 80.0, 520.0, 95.0)) and rows(clipped)
