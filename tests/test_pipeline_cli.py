"""The whole pipeline's outputs and the command line."""

from pyspark.sql import functions as F

from hexaccess.__main__ import main
from hexaccess.plans import jobs
from tests.conftest import SF_SMALL


def test_pipeline_outputs(spark):
    out = jobs.pipeline(spark, SF_SMALL)
    assert set(out) == {"grid", "admin", "facilities", "run_summary", "class_counts", "admin_rollup"}
    grid = out["grid"]
    n = grid.count()
    assert n == jobs.build_grid(jobs.load_inputs(spark, SF_SMALL).admin).count()
    summary = out["run_summary"].first()
    assert summary.total_hexes == n
    # populated hexes carry a class, empty ones none
    assert grid.where((F.col("population") > 0) & F.col("priority_class").isNull()).count() == 0
    assert grid.where((F.col("population") == 0) & F.col("priority_class").isNotNull()).count() == 0
    total = out["admin_rollup"].where(F.col("NAME_0").isNull()).first()
    assert total.n_hexes == n                    # every hexagon centre falls in one admin unit


def test_command_line_writes_outputs(spark, tmp_path):
    out = tmp_path / "run1"
    assert main(["pipeline", "--sf-dir", SF_SMALL, "--out", str(out)]) == 0
    for name in ["grid", "admin", "facilities", "run_summary", "class_counts", "admin_rollup", "hexagons_geojson",
                 "hexagon_tiles", "facility_tiles", "exposed_population", "population_raster", "hazard_raster", "manifest"]:
        assert (out / name).exists()
    g = spark.read.parquet(str(out / "grid"))
    assert g.count() > 0 and abs(g.agg(F.min("centroid.x")).first()[0] - 27.3) < 0.2   # lon/lat output


def test_command_line_reads_stored_inputs(spark, tmp_path):
    """Admin, facility and raster tables stored with headers give the same grid as the frames they were written from."""
    from hexaccess.sinks.writers import write_raster, write_table
    from hexaccess.sources.raster import read_raster
    inp = jobs.load_inputs(spark, SF_SMALL)
    write_table(inp.admin, str(tmp_path / "admin"))
    write_table(inp.facilities, str(tmp_path / "facilities"))
    for name, r in (("population", inp.population), ("flood", inp.flood)):
        write_raster(r.cells, str(tmp_path / name), block=16, meta=r.meta)
        assert read_raster(spark, str(tmp_path / name)).meta == r.meta.with_shape(block=16)
    args = [x for n in ("admin", "facilities", "population", "flood") for x in (f"--{n}", str(tmp_path / n))]
    assert main(["pipeline", *args, "--bbox", "27.3", "-4.5", "29.1", "-3.5", "--study", "a test", "--out", str(tmp_path / "run")]) == 0
    g = spark.read.parquet(str(tmp_path / "run" / "grid"))
    want = jobs.analysis_grid(inp)
    cols = ["hex_id", "population", "priority_class"]
    rows = lambda df: sorted((r[0], round(r[1], 6), r[2] or "") for r in df.select(*cols).collect())
    assert rows(g) == rows(want)
    m = {r["asset"]: r for r in spark.read.parquet(str(tmp_path / "run" / "manifest")).collect()}
    assert m["population_raster"]["n_rows"] == inp.population.cells.count() and m["hazard_raster"]["n_rows"] > 0
    assert m["grid"]["n_rows"] == g.count() and '"study_name": "a test"' in m["grid"]["study"] and m["admin"]["xmin"] is not None
