import heapq
import random

import pytest

from hexaccess.operators import graph


def dijkstra(edges, starts):
    near = {}
    for a, b, c in edges:
        near.setdefault(a, []).append((b, c))
        near.setdefault(b, []).append((a, c))
    best, heap = {}, [(d, s) for s, d in starts.items()]
    heapq.heapify(heap)
    while heap:
        d, v = heapq.heappop(heap)
        if v not in best:
            best[v] = d
            for w, c in near.get(v, []):
                heapq.heappush(heap, (d + c, w))
    return best


def run(spark, edges, starts, **params):
    e = spark.createDataFrame([(i, a, b, float(c)) for i, (a, b, c) in enumerate(edges)], "id long, source string, target string, cost double")
    s = spark.createDataFrame([(n, float(d)) for n, d in starts.items()], "node string, dist double")
    rows = graph.network_distance(e, s, **params).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["dist"] for r in rows}


@pytest.mark.parametrize("seed,delta", [(0, None), (1, 3.0), (2, 100.0)])
def test_equals_dijkstra(spark, seed, delta):
    """Junctions, chains between them, dead ends, loops, parallel edges, a ring and parts that no source reaches."""
    rng = random.Random(seed)
    edges = [(f"j{rng.randrange(12)}", f"j{rng.randrange(12)}", rng.randint(1, 9)) for _ in range(18)]
    for c in range(10):
        a, b, n = f"j{rng.randrange(12)}", f"j{rng.randrange(12)}", rng.randint(1, 9)
        path = [a, *[f"c{c}_{i}" for i in range(n)], b][: None if c % 4 else -1]
        edges += [(x, y, rng.randint(0, 5)) for x, y in zip(path, path[1:])]
    edges += [(f"r{i}", f"r{(i + 1) % 5}", 1) for i in range(5)] + [("p", "q", 1), ("j1", "j1", 3), edges[0], (*edges[0][:2], 1)]
    starts = {"j0": 0, "c1_0": 2, "c2_1": 0, "nowhere": 4, "j3": 7}
    got, want = run(spark, edges, starts, delta=delta), dijkstra(edges, starts)
    assert got == want


def test_ring_with_one_source_and_empty_tables(spark):
    edges = [(f"r{i}", f"r{(i + 1) % 9}", 1 + i % 2) for i in range(9)]
    assert run(spark, edges, {"r4": 0}) == dijkstra(edges, {"r4": 0})
    assert run(spark, edges, {}) == {}
    assert run(spark, [], {"a": 1}) == {"a": 1.0}


def test_command_line_measures_along_roads(spark, tmp_path):
    """One road through the study area: distances are those of the job, and no shorter than straight ones."""
    from pyspark.sql import functions as F
    from hexaccess.__main__ import main
    from hexaccess.plans import jobs
    from tests.conftest import SF_SMALL
    points = [(27.3 + 0.3 * i, -4.4 + 0.1 * (i % 3)) for i in range(6)]
    lines = [(i, [{"x": a[0], "y": a[1]}, {"x": b[0], "y": b[1]}]) for i, (a, b) in enumerate(zip(points, points[1:]))]
    roads = spark.createDataFrame(lines, "id long, line array<struct<x:double,y:double>>")
    edges, nodes = jobs.road_network(roads)
    ends = {r[c] for r in edges.collect() for c in ("source", "target")}
    assert {r["node"] for r in nodes.collect()} == ends and len(ends) == 6
    roads.write.parquet(str(tmp_path / "roads"))
    with pytest.raises(SystemExit):
        main(["accessibility", "--sf-dir", SF_SMALL, "--method", "network"])
    assert main(["accessibility", "--sf-dir", SF_SMALL, "--method", "network", "--roads", str(tmp_path / "roads"), "--out", str(tmp_path / "run")]) == 0
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "run" / "grid")).where("population > 0").select("hex_id", "nearest_facility_km").collect()}
    inp = jobs.load_inputs(spark, SF_SMALL)
    straight = jobs.accessibility(jobs.exposure(jobs.build_grid(inp.admin), inp.population, inp.flood), inp.facilities)
    want = {r[0]: r[1] for r in straight.where("population > 0").select("hex_id", "nearest_facility_km").collect()}
    assert got.keys() == want.keys() and all(got[h] >= want[h] - 1e-6 for h in want) and any(got[h] > want[h] + 1 for h in want)


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 100,000 edges from one end: written tables grow with the logarithm of its length."""
    written = []
    keep = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name="stage": (written.append(name), keep(df, name))[1])
    n = 100_000
    e = spark.range(n).selectExpr("id", "concat('n', id) AS source", "concat('n', id + 1) AS target", "CAST(id % 3 + 1 AS double) AS cost")
    d = graph.network_distance(e, spark.createDataFrame([("n0",)], "node string"))
    row = d.selectExpr("count(*) AS n", "max(dist) AS far", "max(abs(dist - (CAST(substr(node, 2) AS long) div 3 * 6 + "
                       "CASE CAST(substr(node, 2) AS long) % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END))) AS off").first()
    assert (row["n"], row["far"], row["off"]) == (n + 1, 2.0 * n - 1, 0.0)
    assert len(written) < 30


def test_levels_of_kept_nodes_equal_dijkstra(spark, monkeypatch):
    """Chains, a ring with one source, a ring without, and loops on a junction, contracted in many levels."""
    monkeypatch.setattr(graph, "MANY_NODES", 3)
    monkeypatch.setattr(graph, "SPREAD", 2)
    rng = random.Random(9)
    edges = [(f"c{i}", f"c{i + 1}", rng.randint(0, 9)) for i in range(150)] + [(f"d{i}", f"d{i + 1}", 1) for i in range(60)]
    edges += [(f"r{i}", f"r{(i + 1) % 40}", rng.randint(1, 5)) for i in range(40)] + [(f"o{i}", f"o{(i + 1) % 30}", 1) for i in range(30)]
    edges += [("c70", "l0", 2)] + [(f"l{i}", f"l{i + 1}", 3) for i in range(20)] + [("l20", "c70", 1), ("c20", "d0", 4), ("c90", "d60", 1)]
    starts = {"c3": 1, "r7": 0, "c149": 2}
    assert run(spark, edges, starts) == dijkstra(edges, starts)


def test_long_chain_is_written_few_times(spark, monkeypatch):
    """60,000 edges: the rows written for its chains stay a small multiple of the darts, not one copy a round."""
    rows = []
    keep = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name="stage": (lambda t: (rows.append((name, t.count())), t)[1])(keep(df, name)))
    n = 60_000
    e = spark.range(n).selectExpr("id", "concat('n', id) AS source", "concat('n', id + 1) AS target", "CAST(1 AS double) AS cost")
    d = graph.network_distance(e, spark.createDataFrame([("n0",)], "node string"))
    assert d.selectExpr("count(*)", "max(dist)").first() == (n + 1, float(n))
    written = sum(r for name, r in rows if name == "graph_chains")
    assert written < 2 * n * 6


def test_roads_of_one_small_file_are_spread_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    from hexaccess.sources import derived
    spark.range(0, 40_000, 1, 1).withColumnRenamed("id", "c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    try:
        lines = derived.far_road_segments_lonlat(spark, str(tmp_path))
        counts = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", old)
    assert sum(counts) == 40_000 and len(counts) >= 3 and max(counts) < 20_000
