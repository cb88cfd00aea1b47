"""Plan checks: pushdown into scans, no Python on the core path, no
single-partition windows, and the driver contract."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from hexaccess.plans import jobs, registry
from hexaccess.sources.tables import lake_scan
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bbox_predicate_and_partition_pruning_reach_the_scan(spark):
    path = registry._lake(spark, SF_SMALL)
    df = lake_scan(spark, path, themes=["medium"], bbox=registry.FIXTURE_BOX, with_filename=False).select("id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = _plan(df)
    assert "GreaterThanOrEqual(bbox.xmin,27.5)" in plan and "LessThanOrEqual(bbox.ymax,-3.5)" in plan
    assert "PartitionFilters: [isnotnull(theme" in plan and "medium" in plan


def test_scan_reads_only_needed_columns(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in _plan(orders)


def test_core_path_has_no_python_udf(spark):
    inp = jobs.load_inputs(spark, SF_SMALL)
    g = jobs.exposure(jobs.build_grid(inp.admin), inp.population, inp.flood)
    plan = _plan(g)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Window" not in plan


def test_priority_has_no_single_partition_window(spark):
    g = registry.QUERIES["priority"](spark, SF_SMALL)
    plan = _plan(g)
    assert "Window" not in plan and "SortAggregate" not in plan


def test_entry_runs_and_every_query_has_an_oracle(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.QUERIES) <= set(entry.oracle_sql())
    assert "hex_id" in df.columns and "priority_class" in df.columns


def test_populated_filter_pushed_before_nearest_join(spark):
    inp = jobs.load_inputs(spark, SF_SMALL)
    g = jobs.exposure(jobs.build_grid(inp.admin), inp.population, inp.flood)
    pts = g.where(F.col("population") > 0)
    # the filter stands on the summed side, so the left join with the grid becomes an inner one
    assert "LeftOuter" not in _plan(pts).split("population")[0]
    assert pts.count() <= g.count()


def test_raster_clip_prunes_stored_blocks(spark):
    from hexaccess.operators.raster import raster_clip_box
    from hexaccess.session import scratch_path
    from hexaccess.sinks.writers import write_raster
    from hexaccess.sources.raster import read_raster
    pop = jobs.load_inputs(spark, SF_SMALL).population
    meta = pop.meta.with_shape(block=8)
    path = write_raster(pop.cells, scratch_path(spark, "pop_blocks"), block=meta.block)
    stored = read_raster(spark, path, meta)
    clipped = raster_clip_box(stored, *registry.FIXTURE_BOX)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = _plan(clipped.cells)
    assert "PartitionFilters: [isnotnull(tile_row" in plan
    direct = raster_clip_box(pop, *registry.FIXTURE_BOX)
    assert sorted(map(tuple, clipped.cells.select("row", "col", "value").collect())) == \
        sorted(map(tuple, direct.cells.select("row", "col", "value").collect()))
