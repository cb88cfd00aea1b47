"""Incremental exposure: population raster blocks arrive as files and the
per-hexagon totals are kept as streaming state.

* source: a Parquet folder of cell files (``row, col, value``), read with
  ``readStream`` a few files per micro-batch;
* stream-static left join with the flooded cells of the hazard raster;
* hexagon assignment (Column arithmetic) and a stateful ``groupBy`` sum;
* sink: ``update`` mode through ``foreachBatch`` into an append-only
  Parquet log keyed by batch id (a replayed batch overwrites its own
  folder, so the log is exactly-once); the current totals are the latest
  row per hexagon.  State and progress live in the checkpoint location
  under the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.functions import hexgrid
from hexaccess.params import Params
from hexaccess.plans.jobs import exposed_sums
from hexaccess.sources.raster import CELL_SCHEMA


def exposure_updates(cells: DataFrame, inputs, p: Params) -> DataFrame:
    """Streaming cells -> running per-hexagon totals, by the batch's own function
    (nodata and the CRS of both rasters included)."""
    return exposed_sums(cells, inputs.population.meta, inputs.flood, p)


def run_exposure_stream(spark: SparkSession, inputs, p: Params, base: str, files_per_batch: int = 2) -> DataFrame:
    """Land the population cells by storage block, stream them through
    ``exposure_updates`` until all are processed, and return the totals."""
    landing, log, ckpt = f"{base}/landing", f"{base}/totals_log", f"{base}/checkpoint"
    block = inputs.population.meta.block
    (inputs.population.cells.select("row", "col", "value")
     .repartition(F.floor(F.col("row") / F.lit(block)), F.floor(F.col("col") / F.lit(block)))
     .write.mode("overwrite").parquet(landing))
    stream = (spark.readStream.schema(CELL_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
              .parquet(landing))
    totals = exposure_updates(stream, inputs, p)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    q = (totals.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    t = compact_totals(spark, log, f"{base}/totals")
    return t.select(hexgrid.hex_id(F.lit(p.resolution), F.col("q"), F.col("r")).alias("hex_id"),
                    "population", "population_exposed")


def compact_totals(spark: SparkSession, log: str, path: str) -> DataFrame:
    """The run's log folded into one table of current totals, which later reads use."""
    latest_totals(spark, log).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def latest_totals(spark: SparkSession, log: str) -> DataFrame:
    """Current totals: for each hexagon, the row of its latest batch."""
    rows = spark.read.parquet(log)
    return rows.groupBy("q", "r").agg(
        F.max_by("population", "batch_id").alias("population"),
        F.max_by("population_exposed", "batch_id").alias("population_exposed"))
