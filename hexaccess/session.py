"""Session helpers: build a session for tests/bench and find shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def current_session(app_name: str = "hexaccess") -> SparkSession:
    """The caller's session with its own settings (under spark-submit: the cluster's), or a
    plain new one; the command line uses this."""
    return SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "hexaccess") -> SparkSession:
    """Local session used by tests and bench.  On a cluster the caller's
    session (and its spark-defaults) is used instead."""
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Only a `local[...]` session that has none (tests) gets a fresh local
    folder; a cluster's own `spark.checkpoint.dir` is never overridden, and
    a cluster without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hexaccess-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share; "
                           "a machine-local folder is only used with a local[...] master")
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """This application's own folder of stage tables under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hexaccess-tables/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, in the run's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_stage_tables(spark: SparkSession) -> None:
    """Delete the stage tables of this application (for the end of a run: frames built on them can't be read any more)."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df, name: str = "stage"):
    """Write a stage result as a Parquet table under the shared checkpoint
    folder and read it back.  Lineage is cut, so later stages (and a lost
    executor) never recompute upstream work; unlike ``checkpoint()`` the
    input is computed only once, and the re-read table carries file
    statistics for AQE."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
