"""Vector tables for the searches: one row (vec_id, v) per id, v the components as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from hexaccess.llm.common import stage_table


def vector_table(table: DataFrame, keep_zero: bool, column: str = "embedding") -> tuple[DataFrame, int, str]:
    """(rows (vec_id, v), dimensions, numpy type of v).

    Rows of null vec_id, and vectors that are null, empty, hold null or
    non-finite components, (unless ``keep_zero``) are zero, or are not of the
    most common length, take no part.  An id that stands more than once counts
    once, with the smallest of its vectors by components.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(
        F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & (F.lit(keep_zero) | F.exists("x", lambda x: x != 0)))
    kind = "<f4" if isinstance(table.schema[column].dataType.elementType, FloatType) else "<f8"
    lengths = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    dims = lengths[0]["n"] if lengths else 1
    single = rows.where(F.size("x") == dims).groupBy("vec_id").agg(F.min("x").alias("x"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": [np.asarray(x, dtype=kind).tobytes() for x in b["x"]]})

    return stage_table(single.mapInPandas(packed, "vec_id long, v binary"), "vectors"), dims, kind


def matrix(column: pd.Series, dims: int, kind: str) -> np.ndarray:
    """The vectors of a column as rows, in double precision."""
    return np.frombuffer(b"".join(column), dtype=kind).reshape(-1, dims).astype(np.float64)


def sample_rows(rows: DataFrame, n: int) -> pd.DataFrame:
    """At most n rows, the first in the order of a hash of vec_id."""
    return rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).toPandas()


def best_rows(found: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows of each query_id, with their rank; every task first limits its own rows."""
    w = Window.partitionBy("query_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
