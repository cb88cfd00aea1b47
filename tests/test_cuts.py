"""What must not be cut: inputs on which an earlier version lost data or changed its ways."""

import pytest
from pyspark.sql import functions as F

from hexaccess.functions import display, geo
from hexaccess.operators.raster import reproject_xy, target_grid_meta
from hexaccess.params import Params
from hexaccess.plans import jobs
from hexaccess.plans.registry import QUERIES
from hexaccess.sources.raster import Raster, RasterMeta
from tests.conftest import SF_MID, SF_SMALL


def test_wkt_keeps_all_rings_parts_and_digits(spark):
    texts = ["POLYGON((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "SRID=4326;MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.1 5.1, 5.2 5.1, 5.2 5.2, 5.1 5.1)))",
             "POINT(1 2)", "LINESTRING(0 0, 1 1, 2 0)", "POLYGON EMPTY"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", geo.wkt_to_parts(F.col("t")).alias("p")).collect()}
    assert [len(p) for p in got[0]] == [2] and [len(p) for p in got[1]] == [1, 2]
    assert [(p.x, p.y) for p in got[1][1][1]] == [(5.1, 5.1), (5.2, 5.1), (5.2, 5.2), (5.1, 5.1)]
    assert [(p.x, p.y) for p in got[2][0][0]] == [(1.0, 2.0)] and len(got[3][0][0]) == 3 and got[4] == []
    tiny = df.limit(1).select(geo.ring_to_wkt(geo.box_ring(F.lit(27.00001), F.lit(-4.0), F.lit(27.00013), F.lit(-3.99991))).alias("w"))
    ring = tiny.select(geo.wkt_to_ring(F.col("w")).alias("r")).first()["r"]
    assert {p.x for p in ring} == {27.00001, 27.00013} and {p.y for p in ring} == {-4.0, -3.99991}


@pytest.mark.parametrize("box", [(26.0, -4.5, 29.0, -3.5), (24.0, -4.5, 30.5, -3.5)])
def test_target_grid_covers_every_corner(spark, box):
    meta = RasterMeta.from_bounds(*box, 40, 20)
    dst = target_grid_meta(spark, meta, "EPSG:32735")
    w, s, e, n = dst.bounds
    corners = spark.range(41 * 21).select((F.lit(box[0]) + (F.col("id") % 41) * meta.dx).alias("x"), (F.lit(box[1]) + F.floor(F.col("id") / 41) * meta.dy).alias("y"))
    p = reproject_xy(F.col("x"), F.col("y"), "EPSG:4326", "EPSG:32735")
    b = corners.select(p.alias("p")).agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first()
    assert w <= b[0] + 1e-6 and s <= b[1] + 1e-6 and e >= b[2] - 1e-6 and n >= b[3] - 1e-6


def _four_cells(spark, crs="EPSG:4326", box=(27.3, -4.5, 27.5, -4.3)):
    meta = RasterMeta.from_bounds(*box, 2, 2, crs, nodata=-99999.0)
    pop = spark.createDataFrame([(0, 0, 40.0), (0, 1, 30.0), (1, 0, -99999.0), (1, 1, float("nan"))], "row bigint, col bigint, value double")
    wet = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.0), (1, 0, -99999.0), (1, 1, 2.0)], "row bigint, col bigint, value double")
    return Raster(pop, meta), Raster(wet, meta)


def test_stream_and_batch_agree_on_nodata(spark, tmp_path):
    from hexaccess.streaming.exposure_stream import run_exposure_stream
    pop, wet = _four_cells(spark)
    batch = jobs.zonal_exposure(pop, wet).agg(F.sum("population"), F.sum("population_exposed")).first()
    inputs = jobs.Inputs(admin=None, facilities=None, population=pop, flood=wet)
    got = run_exposure_stream(spark, inputs, Params(), str(tmp_path / "s")).agg(F.sum("population"), F.sum("population_exposed")).first()
    assert tuple(batch) == tuple(got) == (70.0, 40.0)


def test_exposure_of_rasters_in_two_systems(spark, tmp_path):
    """A population raster in lon/lat and a hazard raster in UTM: the same sums in batch and stream, and those of the cells one by one."""
    from hexaccess.streaming.exposure_stream import run_exposure_stream
    inp = jobs.load_inputs(spark, SF_SMALL)
    meta = target_grid_meta(spark, inp.flood.meta, "EPSG:32735")
    from hexaccess.operators.raster import raster_nearest
    utm = Raster(raster_nearest(inp.flood, meta), meta)
    two = jobs.Inputs(admin=inp.admin, facilities=inp.facilities, population=inp.population, flood=utm)
    cells = jobs.exposure_cells(inp.population, utm)
    want = cells.agg(F.sum("value"), F.sum(F.when(F.col("depth") > 0, F.col("value")))).first()
    for got in (jobs.zonal_exposure(inp.population, utm), run_exposure_stream(spark, two, Params(), str(tmp_path / "s"))):
        row = got.agg(F.sum("population"), F.sum("population_exposed")).first()
        assert row[0] == pytest.approx(want[0]) and row[1] == pytest.approx(want[1])


def test_popup_defaults(spark):
    rows = [("", "", 1), (None, None, 2), ("A", "clinic", 3)]
    got = {r["id"]: (r["name_text"], r["type_text"]) for r in
           display.facility_popup(spark.createDataFrame(rows, "name string, amenity string, id int")).collect()}
    assert got[1] == got[2] == ("Unnamed", "Health facility") and got[3] == ("A", "clinic")
    hexes = spark.createDataFrame([("h", float("nan"), None, float("nan"), None, "", "", float("nan"))],
                                  "hex_id string, population double, population_exposed double, exposure_pct double, "
                                  "nearest_facility_km double, accessibility_class string, priority_class string, priority_score double")
    r = display.hex_popup(hexes).first()
    assert (r["population_text"], r["exposed_text"], r["accessibility_text"], r["priority_text"]) == ("0", "0 (0.0%)", "N/A", "N/A (0.000)")


def test_every_hexagon_has_a_theme_count(spark):
    got = QUERIES["theme_count_by_hex"](spark, SF_MID)
    assert got.count() == QUERIES["hex_grid"](spark, SF_MID).count()
    assert got.where("n_places = 0").count() > 0


def test_thinning_tells_what_it_drops(spark):
    from hexaccess.operators.tiles import tile_thin
    t = spark.createDataFrame([(6, 1, 1, f"h{i}", float(i)) for i in range(9)] + [(6, 1, 2, "h", 1.0)],
                              "zoom int, tile_x int, tile_y int, hex_id string, score double")
    got = tile_thin(t, 4, [F.col("score").desc()]).collect()
    assert sorted((r["tile_y"], r["hex_id"], r["n_dropped"]) for r in got) == [(1, "h5", 5), (1, "h6", 5), (1, "h7", 5), (1, "h8", 5), (2, "h", 0)]


def test_rejected_units_come_back(spark):
    from hexaccess.operators.vector import repair
    bow = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 2D, 'y', 2D), named_struct('x', 2D, 'y', 0D), named_struct('x', 0D, 'y', 2D), named_struct('x', 0D, 'y', 0D))"
    df = spark.sql(f"SELECT 1 AS id, {bow} AS ring")
    ok, rejects = repair(df)
    assert ok.count() == 0 and rejects.count() == 1


def test_checkpoint_folder_must_be_shared():
    from hexaccess.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_geojson_keeps_attributes_and_geometries(spark, tmp_path):
    import json
    from hexaccess.sources.tables import geojson_features
    square = [[0, 0], [2, 0], [2, 2], [0, 0]]
    hole = [[0.5, 0.2], [1, 0.2], [1, 0.4], [0.5, 0.2]]
    features = [({"name": "A", "beds": 12, "open": True}, {"type": "Point", "coordinates": [27.5, -4.0]}),
                ({"id": "p", "level": "3"}, {"type": "Polygon", "coordinates": [square, hole]}),
                ({}, {"type": "MultiPolygon", "coordinates": [[square], [square, hole]]}),
                ({"surface": None}, {"type": "LineString", "coordinates": [[0, 0], [1, 1], [2, 1]]})]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": f"f{i}", "properties": p, "geometry": g} for i, (p, g) in enumerate(features)]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    got = {r["id"]: r for r in geojson_features(spark, str(tmp_path / "a.json")).collect()}
    assert got["f0"]["properties"] == {"name": "A", "beds": "12", "open": "true"} and (got["f0"]["lon"], got["f0"]["lat"]) == (27.5, -4.0)
    assert got["p"]["properties"]["level"] == "3" and [len(p) for p in got["p"]["parts"]] == [2]
    assert [len(p) for p in got["f2"]["parts"]] == [1, 2] and got["f2"]["parts"][1][1][0].x == 0.5
    assert [(p.x, p.y) for p in got["f3"]["points"]] == [(0, 0), (1, 1), (2, 1)] and got["f3"]["parts"] is None
