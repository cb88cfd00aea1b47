"""Accessibility expectations and nearest-search exactness."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hexaccess.functions import scoring
from hexaccess.operators.nearest import nearest


@pytest.mark.parametrize("d,cls", [(2.5, "good"), (7.5, "moderate"), (15.0, "poor"),
                                   (5.0, "moderate"), (10.0, "poor"), (30.0, "poor"), (0.0, "good")])
def test_access_class(spark, d, cls):
    got = spark.createDataFrame([(d,)], "d double").select(scoring.access_class(F.col("d"))).first()[0]
    assert got == cls


@pytest.mark.parametrize("d,score", [(0.0, 1.0), (2.0, 0.8), (5.0, 0.5), (7.0, 0.38), (10.0, 0.2),
                                     (12.0, 0.18), (30.0, 0.0), (45.0, 0.0)])
def test_access_score(spark, d, score):
    got = spark.createDataFrame([(d,)], "d double").select(scoring.access_score(F.col("d"))).first()[0]
    assert 0.0 <= got <= 1.0
    assert got == pytest.approx(score)


def test_null_distance_keeps_null_class(spark):
    r = spark.createDataFrame([(None,)], "d double").select(
        scoring.access_class(F.col("d")), scoring.access_score(F.col("d"))).first()
    assert r[0] is None and r[1] is None


def _brute(points, facs, k):
    out = {}
    for pid, px, py in points:
        ds = sorted(((px - fx) ** 2 + (py - fy) ** 2, fid) for fid, fx, fy in facs)
        out[pid] = [(fid, math.sqrt(d2)) for d2, fid in ds[:k]]
    return out


@pytest.mark.parametrize("k,seed,clustered", [(1, 1, False), (1, 2, True), (3, 3, False), (2, 4, True)])
def test_bucket_nearest_equals_brute_force(spark, k, seed, clustered):
    rnd = random.Random(seed)
    if clustered:   # a third of the facilities sit on one spot, the rest spread out
        facs = [(i, 5000.0, 5000.0) for i in range(20)] + [
            (20 + i, rnd.uniform(0, 100000), rnd.uniform(0, 60000)) for i in range(40)]
    else:
        facs = [(i, rnd.uniform(0, 100000), rnd.uniform(0, 60000)) for i in range(60)]
    points = [(i, rnd.uniform(-20000, 120000), rnd.uniform(-20000, 80000)) for i in range(300)]
    P = spark.createDataFrame(points, "hex_id long, x double, y double")
    Fd = spark.createDataFrame(facs, "id long, x double, y double")
    got = {}
    for r in nearest(P, Fd, k=k).collect():
        got.setdefault(r.hex_id, []).append((r.rank, r.facility_id, r.distance_m))
    want = _brute(points, facs, k)
    assert set(got) == set(want)
    for pid, rows in got.items():
        rows.sort()
        assert [round(d, 6) for _, _, d in rows] == [round(d, 6) for _, d in want[pid]]
        if k == 1:
            assert rows[0][1] == want[pid][0][0]   # ties -> smallest id


def test_nearest_is_minimum_and_non_negative(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 0.0)], "hex_id long, x double, y double")
    Fd = spark.createDataFrame([(7, 3000.0, 4000.0), (8, 1000.0, 0.0)], "id long, x double, y double")
    got = {r.hex_id: (r.facility_id, r.distance_m) for r in nearest(P, Fd).collect()}
    assert got == {1: (8, 1000.0), 2: (8, 0.0)}


def test_equal_distance_tie_takes_smaller_id(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0)], "hex_id long, x double, y double")
    Fd = spark.createDataFrame([(9, 100.0, 0.0), (4, -100.0, 0.0)], "id long, x double, y double")
    assert nearest(P, Fd).first().facility_id == 4


def test_no_facilities_gives_no_rows(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0)], "hex_id long, x double, y double")
    Fd = spark.createDataFrame([], "id long, x double, y double")
    assert nearest(P, Fd).count() == 0


@pytest.mark.parametrize("k", [1, 4])
def test_round_two_heavy_case_is_exact(spark, k):
    # facilities in a few tight clumps far apart: most points are resolved only in round 2
    rnd = random.Random(7 + k)
    facs = []
    for c, (cx, cy) in enumerate([(0.0, 0.0), (90000.0, 10000.0), (40000.0, 70000.0)]):
        for i in range(15):
            facs.append((c * 100 + i, cx + rnd.uniform(-300, 300), cy + rnd.uniform(-300, 300)))
    points = [(i, rnd.uniform(-30000, 130000), rnd.uniform(-30000, 100000)) for i in range(600)]
    P = spark.createDataFrame(points, "hex_id long, x double, y double")
    Fd = spark.createDataFrame(facs, "id long, x double, y double")
    got = {}
    for r in nearest(P, Fd, k=k).collect():
        got.setdefault(r.hex_id, []).append((r.rank, r.facility_id, r.distance_m))
    want = _brute(points, facs, k)
    assert set(got) == set(want)
    for pid, rows in got.items():
        rows.sort()
        assert [(f, round(d, 6)) for _, f, d in rows] == [(f, round(d, 6)) for f, d in want[pid]]


@pytest.mark.parametrize("k", [1, 3])
def test_dense_town_needs_few_pairs(spark, k):
    """4,000 facilities in one town and 1,000 around; points in the town, at its edge and far off."""
    from hexaccess.operators.nearest import candidate_pairs
    rnd = random.Random(11)
    facs = [(i, rnd.gauss(50000, 300), rnd.gauss(50000, 300)) for i in range(4000)]
    facs += [(4000 + i, rnd.uniform(0, 100000), rnd.uniform(0, 100000)) for i in range(1000)]
    points = [(i, rnd.gauss(50000, 300), rnd.gauss(50000, 300)) for i in range(700)]
    points += [(700 + i, 50000 + rnd.uniform(-3000, 3000), 50000 + rnd.uniform(-3000, 3000)) for i in range(200)]
    points += [(900 + i, rnd.uniform(-50000, 150000), rnd.uniform(-50000, 150000)) for i in range(100)]
    P = spark.createDataFrame(points, "hex_id long, x double, y double")
    Fd = spark.createDataFrame(facs, "id long, x double, y double")
    pairs = candidate_pairs(P, Fd, k=k, point_id="hex_id", px="x", py="y", fac_id="id", fx="x", fy="y", base_cell=None, most_pairs=64)
    most = pairs.groupBy("_pid").count().agg(F.max("count"), F.sum("count")).first()
    assert most[0] <= 64 and most[1] < 64 * len(points)
    got = {}
    for r in nearest(P, Fd, k=k).collect():
        got.setdefault(r.hex_id, []).append((r.rank, r.facility_id, r.distance_m))
    want = _brute(points, facs, k)
    assert all([(f, round(d, 6)) for _, f, d in sorted(got[p])] == [(f, round(d, 6)) for f, d in want[p]] for p in want)


def test_nearest_plan_sorts_no_pairs(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 0.0)], "hex_id long, x double, y double")
    Fd = spark.createDataFrame([(7, 3000.0, 4000.0), (8, 1000.0, 0.0)], "id long, x double, y double")
    plan = nearest(P, Fd)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_buckets_are_counted_where_the_search_needs_them(spark, monkeypatch):
    """20,000 evenly spread facilities and a few points: no more buckets than facilities, and some wider ones, are written."""
    from hexaccess.operators import nearest as search
    rows = {}
    keep = search.materialise

    def counted(df, name="stage"):
        t = keep(df, name)
        rows[name] = rows.get(name, 0) + t.count()
        return t

    monkeypatch.setattr(search, "materialise", counted)
    n = 20_000
    Fd = spark.range(n).selectExpr("id", "(id % 200) * 50D + pmod(hash(id), 40) AS x", "floor(id / 200) * 100D + pmod(hash(id, 1), 90) AS y")
    P = spark.createDataFrame([(i, 700.0 * i, 650.0 * i) for i in range(12)], "hex_id long, x double, y double")
    got = {r.hex_id: round(r.distance_m, 6) for r in nearest(P, Fd).collect()}
    facs = [(r.id, r.x, r.y) for r in Fd.collect()]
    points = [(i, 700.0 * i, 650.0 * i) for i in range(12)]
    assert got == {p: round(v[0][1], 6) for p, v in _brute(points, facs, 1).items()}
    assert rows["occupied"] < 2 * n
