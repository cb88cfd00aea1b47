"""Exact top-k search by inner product: a Voronoi join (operator 4).

Components are turned into integers floor(256 x), so scores are exact.  Pivots
(k-means of a bounded sample) divide all rows into cells.  A cell's summary is
its size, its radius and the k + 1 rows nearest its pivot.  The rows in the
summaries bound every query's k-th best score from below: that is the query's
threshold.  A cell can hold a better row for a query only if
q . pivot + |q| radius reaches the threshold; by this each group of queries gets
the cells that any of its queries needs, and no others.  Cells are dealt out in
chunks of bounded size and query groups in parts of bounded size, so neither a
third of all rows in one cell nor in one group makes a large task.  Each
(query part, chunk) is solved locally; a score below the query's threshold is
not reported.

On vectors without clusters the bounds cut little and the work is that of a
block join of queries and rows - each row moves once per query part, each query
once per chunk - which is what an exact answer then costs.

Edges: see ``vector_table`` for the rows that take part.  Ties go to the
smaller vec_id.  A query with fewer than k other rows gets them all; an empty
table gives an empty result.  Scores beyond 64 bits are cut to the nearest.
Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, stage_table
from hexaccess.llm.vectors import best_rows, matrix, sample_rows, vector_table

K, QUERY_STEP = 5, 50
SAMPLE_ROWS, PIVOTS = 4096, 64
#: Rows of a cell's chunk, and queries of a part, at most about.
CHUNK_ROWS, PART_QUERIES = 4096, 1024
#: Up to so many (part, cell) pairs are broadcast to the rows; beyond that they are shuffled.
BROADCAST_NEEDS = 100_000
SCALE = 256.0


def integers(column: pd.Series, dims: int, kind: str) -> np.ndarray:
    return np.floor(SCALE * matrix(column, dims, kind))


def means(points: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """At most n centres by Lloyd's rounds from evenly spaced points."""
    if not len(points):
        return points[:0]
    centres = points[np.linspace(0, len(points) - 1, min(n, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)[0]
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(axis=0)
    return np.unique(centres, axis=0)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest centre, a slice of points at a time."""
    index, distance = np.zeros(len(points), dtype=np.int64), np.zeros(len(points))
    for at in range(0, len(points), 4096):
        part = points[at:at + 4096]
        d = (part ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None] - 2 * part @ centres.T
        best = d.argmin(axis=1)
        index[at:at + 4096] = best
        distance[at:at + 4096] = np.sqrt(((part - centres[best]) ** 2).sum(axis=1))
    return index, distance


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them exactly unless components are huge."""
    if not len(q) or not len(x) or np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(v) for v in row] for row in q], dtype=object) @ np.array([[int(v) for v in row] for row in x], dtype=object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def top_k(vectors: DataFrame, queries: Column, dims: int, kind: str, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of ``vectors`` (vec_id, v) for its rows where ``queries`` holds."""
    spark = vectors.sparkSession
    pivots = means(integers(sample_rows(vectors, SAMPLE_ROWS)["v"], dims, kind), PIVOTS)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cell, distance = nearest(integers(b["v"], dims, kind), pivots)
            yield b.assign(cell=cell, distance=distance)

    rows = stage_table(vectors.mapInPandas(assign, "vec_id long, v binary, cell int, distance double"), "cells")
    cells = {r["cell"]: (r["n"], r["radius"]) for r in
             rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    near = Window.partitionBy("cell").orderBy("distance", "vec_id")
    witnesses = (rows.withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= k + 1)).select("vec_id", "v").toPandas()
    known_ids, known = witnesses["vec_id"].to_numpy(), integers(witnesses["v"], dims, kind)
    names = np.array(sorted(cells))
    radius = np.array([cells[c][1] for c in names])
    n_queries = rows.where(queries).count()
    groups = means(pivots, max(1, min(PIVOTS, math.ceil(n_queries / PART_QUERIES))))
    group_of = nearest(pivots, groups)[0]

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q = integers(b["v"], dims, kind)
            scores = np.where(b["vec_id"].to_numpy()[:, None] == known_ids[None], -(1 << 63), exact_scores(q, known))
            # with fewer than k rows in the summaries there is no threshold
            least = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(b), -(1 << 63))
            length = np.sqrt((q ** 2).sum(axis=1))
            most = q @ pivots[names].T + length[:, None] * radius[None]
            slack = 1e-9 * (length[:, None] * (np.sqrt((pivots[names] ** 2).sum(axis=1)) + radius)[None] + 1) + 1
            needs = most + slack >= least[:, None]
            yield b.assign(grp=group_of[b["cell"].to_numpy()], least=least, needs=[names[n].tolist() for n in needs])[
                ["vec_id", "v", "grp", "least", "needs"]]

    asked = stage_table(rows.where(queries).mapInPandas(plan, "vec_id long, v binary, grp int, least long, needs array<int>"), "queries")
    sizes = {r["grp"]: r["count"] for r in asked.groupBy("grp").count().collect()}
    parts = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, math.ceil(n / PART_QUERIES))]) if sizes else F.create_map()
    chunks = F.create_map(*[F.lit(x) for c, (n, _) in cells.items() for x in (int(c), math.ceil(n / CHUNK_ROWS))])
    asked = (asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.element_at(parts, F.col("grp"))).cast("int"))
             .withColumn("cell", F.explode("needs")).drop("needs"))
    needs = stage_table(asked.select("grp", "part", "cell").distinct(), "needs")
    few = needs.count() <= BROADCAST_NEEDS
    dealt = (rows.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.element_at(chunks, F.col("cell"))).cast("int").alias("chunk"))
             .join(F.broadcast(needs) if few else needs, "cell"))
    sent = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.element_at(chunks, F.col("cell")) - 1)))

    def solve(xs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(xs) or not len(qs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        xs = xs.sort_values("vec_id")
        ids, qids = xs["vec_id"].to_numpy(), qs["vec_id"].to_numpy()
        x, q = integers(xs["v"], dims, kind), integers(qs["v"], dims, kind)
        out = []
        for at in range(0, len(q), 256):
            scores = exact_scores(q[at:at + 256], x)
            for i, s in enumerate(scores):
                least = qs["least"].iat[at + i]
                good = np.flatnonzero((s >= least) & (ids != qids[at + i]))
                good = good[np.argsort(-s[good], kind="stable")[:k]] if len(good) else good  # ids ascend, so ties do
                out.append(pd.DataFrame({"query_id": qids[at + i], "vec_id": ids[good], "score": s[good]}))
        return pd.concat(out)

    unit = ["grp", "part", "cell", "chunk"]
    found = (dealt.groupBy(*unit).cogroup(sent.groupBy(*unit))
             .applyInPandas(solve, "query_id long, vec_id long, score long"))
    return best_rows(found, [F.col("score").desc(), "vec_id"], k).select("query_id", "rank", "vec_id", "score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, dims, kind = vector_table(read_table(spark, sf_dir, "embeddings"), keep_zero=True)
    return top_k(vectors, F.col("vec_id") % QUERY_STEP == 0, dims, kind)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
