"""Skew-safe top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: list[str], k: int, order: list[Column], tiebreak: str,
                    rank_col: str = "group_rank", salts: int = 16) -> DataFrame:
    """Rows ranked 1..k within each group of ``keys`` by ``order`` then
    ``tiebreak``.  Two phases: a row_number inside (group, salt) keeps at
    most k rows per salt, then the group ranks at most ``k * salts``
    survivors -- so a group holding a third of all rows is never sorted
    whole in one task."""
    ordering = [*order, F.col(tiebreak)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(salts)))
    first = salted.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*ordering)))
    first = first.where(F.col("_rn") <= k).drop("_salt", "_rn")
    ranked = first.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    return ranked.where(F.col(rank_col) <= k)
