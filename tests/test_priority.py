"""Priority expectations: normalisation, weights, percentile classes, inversion."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexaccess.functions import scoring
from hexaccess.operators.stats import exact_percentiles
from hexaccess.params import Params
from hexaccess.plans import jobs


def test_minmax_normalise_to_unit_range(spark):
    df = spark.createDataFrame([(v,) for v in [20.0, 30.0, 40.0, 50.0, 60.0]], "v double")
    out = [r[0] for r in df.select(scoring.minmax_scale(F.col("v"), F.lit(20.0), F.lit(60.0))).collect()]
    assert out == [0.0, 0.25, 0.5, 0.75, 1.0]
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r[0] for r in same.select(scoring.minmax_scale(F.col("v"), F.lit(5.0), F.lit(5.0))).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("we,wa", [(0.6, 0.4), (0.5, 0.5), (0.7, 0.3)])
def test_weighted_score(spark, we, wa):
    r = spark.createDataFrame([(0.8, 0.4)], "e double, a double").select(
        scoring.priority_score(F.col("e"), F.col("a"), we, wa)).first()[0]
    assert r == pytest.approx(0.8 * we + 0.6 * wa)
    assert 0.0 <= r <= 1.0


def test_inversion(spark):
    df = spark.createDataFrame([(1.0,), (0.7,), (0.3,), (0.0,), (None,)], "s double")
    assert [round(r[0], 9) for r in df.select(scoring.inaccessibility(F.col("s"))).collect()] == [0.0, 0.3, 0.7, 1.0, 1.0]


def _grid(spark, scores, exposed=None):
    rows = [(f"h{i}", 1.0, float(i) if exposed is None else exposed, s) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "hex_id string, population double, population_exposed double, accessibility_score double")


def test_one_high_of_five_at_top_20(spark):
    # priority = inaccessibility only, scores 0.9 0.7 0.5 0.3 0.1 -> p80 = 0.74
    g = _grid(spark, [0.1, 0.3, 0.5, 0.7, 0.9])
    p = Params(exposure_weight=0.0, accessibility_weight=1.0, top_percentile=20)
    out = jobs.priority(g, p, materialise_input=False)
    classes = {r.hex_id: r.priority_class for r in out.collect()}
    assert list(classes.values()).count("high") == 1
    assert classes["h0"] == "high"
    hi, mid = jobs.priority_thresholds(jobs.priority_scores(g, p), p)
    assert hi == pytest.approx(0.74) and mid == pytest.approx(0.5)


def test_all_scores_equal_are_high(spark):
    g = _grid(spark, [0.5] * 4, exposed=3.0)
    out = jobs.priority(g, Params(), materialise_input=False)
    assert {r.priority_class for r in out.collect()} == {"high"}


@pytest.mark.parametrize("n,distinct", [(1, 1), (2, 2), (1000, 1000), (5000, 7)])
def test_exact_percentiles_match_numpy(spark, n, distinct):
    rnd = random.Random(n)
    vals = [float(rnd.randrange(distinct)) * 0.37 + rnd.random() * (distinct > 100) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = exact_percentiles(df, "v", probs, buckets=8)   # force several refinement passes
    want = np.percentile(np.array(vals), [p * 100 for p in probs])
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_exact_percentiles_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_percentiles(df, "v", [0.5]) == [None]


def test_one_populated_hex(spark):
    rows = [("h0", 250.0, 40.0, 0.6), ("h1", 0.0, 0.0, None), ("h2", 0.0, 0.0, None)]
    g = spark.createDataFrame(rows, "hex_id string, population double, population_exposed double, accessibility_score double")
    out = {r.hex_id: r for r in jobs.priority(g, Params(), materialise_input=False).collect()}
    assert out["h0"].exposure_score == 0.0                      # max == min -> 0
    assert out["h0"].priority_score == pytest.approx(0.4 * 0.4)
    assert out["h0"].priority_class == "high"
    assert out["h1"].priority_class is None and out["h1"].priority_score is None
