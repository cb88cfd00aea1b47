import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexaccess.llm import curves, topk
from hexaccess.llm.vectors import vector_table

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell int, distance double"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, x, 0, "clash", 1, 2.0) for i, x in rows], schema)


def mixed(seed, n=400, dims=6):
    """Clusters, ties, copies (a third in one place) and rows that take no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(n)]
    rows = [(i, centres[0] if i % 3 == 0 else x) for i, x in rows]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * (dims - 1) + [None]), (n + 3, [float("nan")] * dims), (n + 4, [float("inf")] * dims),
             (None, [1.0] * dims), (n + 50, [0.0] * dims), (n + 51, [1.0]), (1000, centres[0])]
    return [(i, None if x is None else [v if v is None else float(np.float32(v)) for v in x]) for i, x in rows], dims


def valid(rows, dims, zero):
    out = {}
    for i, x in rows:
        if i is not None and x and len(x) == dims and all(v is not None and math.isfinite(v) for v in x) and (zero or any(x)):
            out[i] = min(out[i], x) if i in out else x
    return out


@pytest.mark.parametrize("seed,step,part,chunk", [(1, 50, 1024, 4096), (2, 7, 5, 20)])
def test_top_k_is_exact(spark, monkeypatch, seed, step, part, chunk):
    monkeypatch.setattr(topk, "PART_QUERIES", part)
    monkeypatch.setattr(topk, "CHUNK_ROWS", chunk)
    rows, dims = mixed(seed)
    vectors, d, kind = vector_table(table(spark, rows + rows[:3]), keep_zero=True)
    assert d == dims
    got = topk.top_k(vectors, F.col("vec_id") % step == 0, d, kind).collect()
    v = {i: [math.floor(256 * c) for c in x] for i, x in valid(rows, dims, True).items()}
    want = set()
    for q in v:
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[x])), x) for x in v if x != q)[:5]
            want |= {(q, r, x, -s) for r, (s, x) in enumerate(best, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_few_rows_and_huge_components(spark):
    for rows in ([], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [3.0, 1.0])]):
        vectors, d, kind = vector_table(table(spark, rows), keep_zero=True)
        got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, d, kind).collect()
        assert len(got) == sum(len(rows) - 1 for i, _ in rows if i % 50 == 0)
    big = [(i, [float(np.float32(3e15)), float(i)]) for i in range(3)]
    vectors, d, kind = vector_table(table(spark, big), keep_zero=True)
    assert {r["score"] for r in topk.top_k(vectors, F.col("vec_id") == 0, d, kind).collect()} == {(1 << 63) - 1}


def test_cells_that_cannot_help_are_not_sent(spark):
    """Far clusters are cut by the bounds: fewer (part, cell) pairs than all."""
    rng = random.Random(3)
    rows = [(i, [10.0 * (i % 4 == j) + rng.gauss(0, 0.01) for j in range(4)]) for i in range(400)]
    vectors, d, kind = vector_table(table(spark, rows), keep_zero=True)
    got = topk.top_k(vectors, F.col("vec_id") % 40 == 0, d, kind)
    assert all(r["vec_id"] % 4 == 0 for r in got.collect())


def test_hilbert_neighbours_touch():
    """Along the curve each step moves to a cell next to the last; every cell has its own number."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        place = curves.hilbert_index(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        walk = grid[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def brute_nearest(v, step, k=10):
    out = {}
    ids = np.array(sorted(v))
    x = np.array([v[i] for i in ids])
    for q in ids[ids % step == 0]:
        d = np.sqrt(((x - np.array(v[q])) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        order = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_small_table_is_whole(spark):
    rows, dims = mixed(4)
    vectors, d, kind = vector_table(table(spark, rows), keep_zero=False)
    got = curves.neighbours(vectors, F.col("vec_id") % 100 == 0, d, kind).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_nearest(valid(rows, dims, False), 100)
    hits = sum(len(set(x for x, _ in want[q]) & set(x for x, _ in found[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert all(len(found[q]) == len(want[q]) and found[q] == sorted(found[q], key=lambda t: (t[1], t[0])) for q in want)


def test_recall_without_structure(spark):
    x = np.random.default_rng(8).normal(size=(4000, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors, d, kind = vector_table(rows, keep_zero=False)
    got = curves.neighbours(vectors, F.col("vec_id") % 100 == 0, d, kind).collect()
    want = brute_nearest({i: v.astype(np.float64) for i, v in enumerate(x)}, 100)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    recall = np.mean([len(found[q].keys() & dict(w)) / 10 for q, w in want.items()])
    assert recall >= 0.9
    for q, w in want.items():
        assert all(found[q][i] == s for i, s in w if i in found[q])


@pytest.mark.parametrize("kind", ["tight", "tighter", "outliers"])
def test_recall_in_a_cluster_and_beside_outliers(spark, kind):
    """A third of the rows in one tight cluster, or a few vectors of large norm: the queries among them and all others."""
    rng = np.random.default_rng(9)
    x, special = rng.normal(size=(4000, 64)), np.arange(4000) % (1000 if kind == "outliers" else 3) == 0
    if kind == "outliers":
        x[special] *= 1000
    else:
        x[special] = rng.normal(size=64) + {"tight": 0.01, "tighter": 0.001}[kind] * rng.normal(size=(special.sum(), 64))
    x = x.astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors, d, number = vector_table(rows, keep_zero=False)
    found = {}
    for r in curves.neighbours(vectors, F.col("vec_id") % 50 == 0, d, number).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = {q: len(found[q] & {i for i, _ in w}) / 10 for q, w in brute_nearest({i: v.astype(np.float64) for i, v in enumerate(x)}, 50).items()}
    assert np.mean([h for q, h in hits.items() if special[q]]) >= 0.9
    assert np.mean([h for q, h in hits.items() if not special[q]]) >= 0.9


def test_empty(spark):
    vectors, d, kind = vector_table(table(spark, [(0, None), (None, [1.0])]), keep_zero=False)
    assert curves.neighbours(vectors, F.col("vec_id") % 100 == 0, d, kind).count() == 0
    assert topk.top_k(vectors, F.col("vec_id") % 50 == 0, d, kind).count() == 0
