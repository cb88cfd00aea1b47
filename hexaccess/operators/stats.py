"""Global statistics without single-task bottlenecks.

* ``minmax_scalars``: min/max as scalar-subquery Columns (partial
  aggregates per task, one tiny final row), attached lazily to any frame.
* ``exact_percentiles``: interpolated percentiles (the same linear rule
  as NumPy's default / SQL ``quantile_cont``) found by distributed
  histogram refinement.  Each pass is one grouped count over at most
  ``buckets`` keys; only those counts reach the driver, never the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_scalars(df: DataFrame, col: str) -> tuple[Column, Column]:
    agg = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return agg.select("lo").scalar(), agg.select("hi").scalar()


def _rank_value(v: DataFrame, rank: int, lo: float, hi: float, below: int,
                buckets: int, memo: dict) -> float:
    """Value at 0-based ``rank`` given that the values in [lo, hi] (``below``
    values are smaller) contain it.  Each pass keeps one bucket; its least
    and greatest value lie in different buckets of the next pass, so the
    range shrinks until it is a single value."""
    while True:
        if lo == hi:
            return lo
        window = v.where((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
        width = hi - lo
        b = F.least(F.greatest(F.floor((F.col("v") - F.lit(lo)) / F.lit(width) * F.lit(buckets)),
                               F.lit(0)), F.lit(buckets - 1))
        key = ("hist", lo, hi)
        if key not in memo:
            memo[key] = (window.groupBy(b.alias("b"))
                         .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                         .collect())
        hist = memo[key]
        acc = below
        for h in sorted(hist, key=lambda r: r["b"]):
            if rank < acc + h["c"]:
                lo, hi, below = float(h["lo"]), float(h["hi"]), acc
                break
            acc += h["c"]
        else:  # pragma: no cover
            raise RuntimeError("rank outside the histogram")


def exact_percentiles(df: DataFrame, col: str, probs: list[float], buckets: int = 1024) -> list[float | None]:
    """Exact linear-interpolated percentiles (probs in [0, 1]) of a column.

    NULL and NaN are ignored.  Returns None for every prob on empty input.
    The input should be materialised (checkpointed) by the caller, since
    it is scanned once per refinement pass (typically 2-3 passes).
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    head = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = int(head["n"])
    if n == 0:
        return [None for _ in probs]
    lo, hi = float(head["lo"]), float(head["hi"])
    cache: dict[int, float] = {}
    memo: dict = {}

    def at(rank: int) -> float:
        if rank not in cache:
            cache[rank] = _rank_value(v, rank, lo, hi, 0, buckets, memo)
        return cache[rank]

    out = []
    for p in probs:
        pos = (n - 1) * p
        lo_i, hi_i = int(math.floor(pos)), int(math.ceil(pos))
        a = at(lo_i)
        if hi_i == lo_i:
            out.append(a)
        else:
            b = at(hi_i)
            out.append(a + (b - a) * (pos - lo_i))
    return out


def table_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame, 0 for an empty table."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
