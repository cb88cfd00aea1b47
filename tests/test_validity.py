"""Faults between the edges of polygons, against all pairs and on a long ring."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from hexaccess.operators.validity import bucketed_edges, _numbered_edges, edge_faults

SCHEMA = "admin_id long, rings array<array<struct<x:double,y:double>>>"


def brute(rings):
    """Counts by exact arithmetic over all pairs of edges."""
    edges = []
    for r, ring in enumerate(rings or []):
        ring = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
        n = len(ring) - 1
        edges += [(r, i, n - 1 if n > 0 and ring[0] == ring[-1] else None, ring[i], ring[i + 1]) for i in range(n)]
    def turn(p, q, s):
        v = (Fraction(q[0]) - Fraction(p[0])) * (Fraction(s[1]) - Fraction(p[1])) - (Fraction(q[1]) - Fraction(p[1])) * (Fraction(s[0]) - Fraction(p[0]))
        return (v > 0) - (v < 0)
    out = [0, 0, 0]
    for i, (r1, e1, last, a, b) in enumerate(edges):
        for r2, e2, _, c, d in edges[i + 1:]:
            o = turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)
            inside = lambda p, q, s: all(min(p[k], q[k]) <= s[k] <= max(p[k], q[k]) for k in (0, 1))
            meet = any(v == 0 and inside(*t) for v, t in zip(o, ((a, b, c), (a, b, d), (c, d, a), (c, d, b))))
            piece = o[:2] == (0, 0) and any(max(min(a[k], b[k]), min(c[k], d[k])) < min(max(a[k], b[k]), max(c[k], d[k])) for k in (0, 1))
            if r1 == r2 and (e2 == e1 + 1 or (e1 == 0 and e2 == last)):
                out[1] += piece
            elif o[0] * o[1] < 0 and o[2] * o[3] < 0:
                out[0] += 1
            elif r1 == r2:
                out[1] += meet
            else:
                out[2] += piece
    return tuple(out)


def test_faults_equal_all_pairs(spark):
    """Known shapes and random rings of whole coordinates, where edges often touch; small buckets, so many are split."""
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    shapes = [[square], [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]], [square, [(1, 1), (2, 1), (2, 2), (1, 1)]],
              [square, [(1, 0), (3, 0), (2, 2), (1, 0)]], [square, [(0, 0), (3, 1), (1, 3), (0, 0)]], [square, [(1, 1), (6, 1), (2, 2), (1, 1)]],
              [[(0, 0), (4, 0), (6, 0), (4, 0), (4, 4), (0, 0)]], [[(0, 0), (2, 0), (2, 0), (4, 0), (2, 0), (2, 3), (0, 0)]],
              [square[:4]], [[(1, 1)]], [[]], [], None, [[(0, 0), (3, 0), (0, 0)]], [[(5, 5), (5, 5), (5, 5)]]]
    rng = random.Random(5)
    for n in (5, 12, 40):
        ring = [(rng.randrange(9), rng.randrange(9)) for _ in range(n)]
        shapes += [[ring + ring[:1]], [ring], [ring + ring[:1], square]]
    rows = [(i, None if s is None else [[(float(x), float(y)) for x, y in r] for r in s]) for i, s in enumerate(shapes)]
    got = {r[0]: tuple(r)[1:] for r in edge_faults(spark.createDataFrame(rows, SCHEMA), rings="rings", most=4).collect()}
    assert got == {i: brute(s) for i, s in rows}
    assert got[0] == got[2] == got[4] == (0, 0, 0) and got[1] == (1, 0, 0) and got[3] == (0, 0, 1)


def test_long_ring_meets_few_edges(spark):
    """100,000 edges, nine in ten of them within a hundredth of the outline; one late vertex reaches across the ring."""
    n = 100_000
    dense = n // 10 * 9
    turns = [2 * math.pi * (i / dense / 100 if i < dense else 0.01 + 0.99 * (i - dense) / (n - dense)) for i in range(n)]
    ring = [(math.cos(t), math.sin(t)) for t in turns]
    ring[n - 500] = (-1.5, 0.0)
    layer = spark.createDataFrame([(1, [ring + ring[:1]])], SCHEMA)
    buckets = bucketed_edges(_numbered_edges(layer, "admin_id", "rings")).groupBy("_part", "_lv", "_cx", "_cy").count()
    row = buckets.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
    assert row[0] < 10 * n and row[1] < 200 * n
    assert edge_faults(layer, rings="rings").first()["n_crossings"] > 0
