"""Exposure expectations (percent range, totals, zero population, mask bound)."""

from pyspark.sql import functions as F

from hexaccess.functions import scoring
from hexaccess.plans import jobs
from tests.conftest import SF_SMALL


def _exposure(spark):
    inp = jobs.load_inputs(spark, SF_SMALL)
    return inp, jobs.exposure(jobs.build_grid(inp.admin), inp.population, inp.flood)


def test_exposure_percent_in_range(spark):
    _, g = _exposure(spark)
    row = g.agg(F.min("exposure_pct").alias("lo"), F.max("exposure_pct").alias("hi")).first()
    assert 0.0 <= row.lo <= row.hi <= 100.0


def test_totals_add_up(spark):
    inp, g = _exposure(spark)
    per_cell = jobs.exposure_cells(inp.population, inp.flood)
    in_grid = per_cell.join(g.select("hex_id"), "hex_id")
    want = in_grid.agg(F.sum("value")).first()[0]
    got = g.agg(F.sum("population")).first()[0]
    assert abs(want - got) < 1e-6
    # exposed never exceeds population, hex by hex
    assert g.where(F.col("population_exposed") > F.col("population") + 1e-9).count() == 0


def test_zero_population_gives_zero_percent(spark):
    df = spark.createDataFrame([(0.0, 0.0), (100.0, 20.0), (200.0, float("nan"))], "pop double, exp double")
    out = [r[0] for r in df.select(scoring.exposure_pct(F.col("exp"), F.col("pop"))).collect()]
    assert out == [0.0, 20.0, 0.0]


def test_flood_mask_bounded_by_population(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 0.5), (10.0, -1.0), (10.0, None)], "pop double, depth double")
    out = [r[0] for r in df.select(scoring.flood_mask(F.col("depth"), F.col("pop"))).collect()]
    assert out == [0.0, 10.0, 0.0, 0.0]
