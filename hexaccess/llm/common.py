"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexaccess.session import materialise

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows under spark.checkpoint.dir and read them back: the
    lineage ends there, so a lost executor repeats at most that step."""
    return materialise(df, name)


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over all rows before this one in the order of the ``order`` columns.

    Rows are range-partitioned; each task sums its own range, and only the
    totals of the ranges (one row per partition) meet on the driver.  ``order``
    must tell all rows apart.
    """
    ranged = stage_table(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                         .withColumn("_range", F.spark_partition_id()), "ranges")
    totals = sorted((r["_range"], r["t"]) for r in
                    ranged.groupBy("_range").agg(F.sum(value).alias("t")).collect())
    bases, base = [], 0
    for part, total in totals:
        bases.append((part, base))
        base += total or 0
    offsets = df.sparkSession.createDataFrame(bases or [(0, 0)], "_range int, _base bigint")
    w = (Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
         .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
            .join(F.broadcast(offsets), "_range")
            .withColumn(out, F.col(out) + F.col("_base")).drop("_range", "_base"))
