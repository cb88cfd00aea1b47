"""Raster operators on cell tables: validity, centres, alignment, clip,
resampling, storage blocks and overviews.

Rasters are joined to each other by computing, per cell, the (row, col)
of the other grid that contains its centre, then an equi-join on that
key -- a shuffle join sized by the data, never a per-pixel Python loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexaccess.functions import geo
from hexaccess.operators.edges import cross_at, inside_runs, polygon_edges, span
from hexaccess.sinks.writers import HEADER_SCHEMA, write_raster
from hexaccess.sources.raster import (Raster, RasterMeta, blocks_a_file, cell_center_x, cell_center_y, cell_of_x,
                                      cell_of_y, read_raster)


def _epsg(crs: str) -> int:
    return int(crs.split(":")[1])


def _utm_zone(crs: str) -> tuple[int, bool]:
    code = _epsg(crs)
    return code % 100, code // 100 == 327


def reproject_xy(x: Column, y: Column, src_crs: str, dst_crs: str) -> Column:
    """Point transform between lon/lat (4326) and UTM (326xx/327xx)."""
    if src_crs == dst_crs:
        return geo.point(x, y)
    if _epsg(src_crs) == 4326:
        zone, south = _utm_zone(dst_crs)
        return geo.to_utm(x, y, zone, south)
    if _epsg(dst_crs) == 4326:
        zone, south = _utm_zone(src_crs)
        return geo.to_lonlat(x, y, zone, south)
    zone, south = _utm_zone(src_crs)
    ll = geo.to_lonlat(x, y, zone, south)
    dzone, dsouth = _utm_zone(dst_crs)
    return geo.to_utm(ll["x"], ll["y"], dzone, dsouth)


def raster_valid(r: Raster) -> DataFrame:
    """Cells with a real value: not NULL, not NaN and not the header's nodata."""
    v = F.col("value")
    cond = v.isNotNull() & ~F.isnan(v)
    if r.meta.nodata is not None:
        cond = cond & (v != F.lit(float(r.meta.nodata)))
    return r.cells.where(cond)


def raster_cell_xy(r: Raster, valid_only: bool = True) -> DataFrame:
    """(row, col, value, x, y): cells with their centre coordinates."""
    cells = raster_valid(r) if valid_only else r.cells
    return cells.withColumn("x", cell_center_x("col", r.meta)).withColumn("y", cell_center_y("row", r.meta))


def raster_align(base: Raster, other: Raster, name: str = "other_value", fill: float = 0.0,
                 only_where: Column | None = None) -> DataFrame:
    """Nearest alignment: for each valid base cell, the value of the other
    raster's cell containing the base cell centre (after a CRS transform
    when the CRSs differ); ``fill`` where there is none.

    ``only_where`` optionally restricts the other raster to cells that
    matter (e.g. ``value > 0`` for a flood mask); it is pushed into the
    other raster's scan, and cells it drops read as ``fill``.
    """
    cells = raster_cell_xy(base)
    p = reproject_xy(F.col("x"), F.col("y"), base.meta.crs, other.meta.crs)
    cells = cells.withColumn("_o", p).withColumn("_orow", cell_of_y(F.col("_o.y"), other.meta)) \
                 .withColumn("_ocol", cell_of_x(F.col("_o.x"), other.meta)).drop("_o")
    o = raster_valid(other)
    if only_where is not None:
        o = o.where(only_where)
    o = o.select(F.col("row").alias("_orow"), F.col("col").alias("_ocol"), F.col("value").alias(name))
    return cells.join(o, ["_orow", "_ocol"], "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(float(fill)))).drop("_orow", "_ocol")


def raster_clip_box(r: Raster, west: float, south: float, east: float, north: float) -> Raster:
    """Keep cells whose centre is inside the box and crop the grid to them."""
    m = r.meta
    c0 = max(0, int(math.ceil((west - m.x0) / m.dx - 0.5)))
    c1 = min(m.n_cols - 1, int(math.floor((east - m.x0) / m.dx - 0.5)))
    r0 = max(0, int(math.ceil((m.y0 - north) / m.dy - 0.5)))
    r1 = min(m.n_rows - 1, int(math.floor((m.y0 - south) / m.dy - 0.5)))
    window = F.col("row").between(r0, r1) & F.col("col").between(c0, c1)
    each = m.block * blocks_a_file(m.block)
    for name, lo, hi in (("tile_row", r0, r1), ("tile_col", c0, c1)):   # stored by block: prune the other blocks and their files
        for column, edge in ((f"{name}_group", each), (name, m.block)):
            if column in r.cells.columns:
                window = window & F.col(column).between(lo // edge, hi // edge)
    cells = r.cells.where(window).select(
        (F.col("row") - r0).alias("row"), (F.col("col") - c0).alias("col"), "value")
    meta = m.with_shape(x0=m.x0 + c0 * m.dx, y0=m.y0 - r0 * m.dy,
                        n_rows=max(r1 - r0 + 1, 0), n_cols=max(c1 - c0 + 1, 0))
    return Raster(cells, meta)


def zone_runs(zones: DataFrame, meta: RasterMeta, zone_col: str, ring_col: str) -> DataFrame:
    """(zone_col, row, lo, hi): where each raster row's line of cell centres is inside a zone (lo <= x < hi).

    Each edge gives its crossings with the rows it spans; between a row's sorted crossings it is
    inside by parity.  Runs of a zone's parts are merged, so a cell is in a zone once."""
    edges = polygon_edges(zones, zone_col, ring_col)
    first = F.ceil((F.lit(meta.y0) - F.greatest("ay", "by")) / F.lit(meta.dy) - 0.5) - 1
    last = F.floor((F.lit(meta.y0) - F.least("ay", "by")) / F.lit(meta.dy) - 0.5) + 1
    rows = edges.select("*", F.explode(span(F.greatest(first, F.lit(0)), F.least(last, F.lit(meta.n_rows - 1)))).alias("row"))
    at = cross_at(cell_center_y("row", meta), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    runs = inside_runs(rows.select(zone_col, "_part", "row", at.alias("_x")).where("_x IS NOT NULL"), [zone_col, "_part", "row"], "_x")
    line = Window.partitionBy(zone_col, "row").orderBy("lo", "hi")
    before = F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.withColumn("_new", F.when(F.col("lo") <= before, 0).otherwise(1))
    return (starts.withColumn("_run", F.sum("_new").over(line)).groupBy(zone_col, "row", "_run")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run"))


def raster_clip_zones(r: Raster, zones: DataFrame, zone_col: str = "zone_id", ring_col: str = "ring") -> DataFrame:
    """(zone_col, row, col, value): the cells whose centre is inside each zone, on the raster's own grid.

    ``zones`` are rows of a ring or an array of rings (outer ring and holes) in the raster's CRS; a
    zone may be several rows.  A zone's runs of inside cells are dealt to column blocks and meet
    the cells by (row, block), so no polygon is in the plan, in a shuffle or in one task, and a
    cell meets only the runs of its own row and block.  ``zone_windows`` has the windows to crop to.
    """
    m = r.meta
    runs = zone_runs(zones, m, zone_col, ring_col)
    low = F.greatest(F.floor((F.col("lo") - F.lit(m.x0)) / F.lit(m.dx) - 0.5) - 1, F.lit(0))
    high = F.least(F.ceil((F.col("hi") - F.lit(m.x0)) / F.lit(m.dx) - 0.5) + 1, F.lit(m.n_cols - 1))
    dealt = runs.select(zone_col, "row", "lo", "hi", F.explode(span(F.floor(low / m.block), F.floor(high / m.block))).alias("_block"))
    cells = r.cells.select("row", "col", "value", F.floor(F.col("col") / m.block).alias("_block"))
    x = cell_center_x("col", m)
    return (cells.join(dealt.withColumn("row", F.col("row").cast("long")), ["row", "_block"])
            .where((x >= F.col("lo")) & (x < F.col("hi"))).select(zone_col, "row", "col", "value"))


def zone_windows(zones: DataFrame, meta: RasterMeta, zone_col: str = "zone_id", ring_col: str = "ring") -> DataFrame:
    """(zone_col, row0, col0, n_rows, n_cols): the window of cells whose centre is within each zone's box, one row per
    zone; the crop's header is the raster's with these figures.  A zone that holds no centre has a window of no cells."""
    edges = polygon_edges(zones, zone_col, ring_col)
    box = edges.groupBy(zone_col).agg(F.min("ax").alias("w"), F.max("ax").alias("e"), F.min("ay").alias("s"), F.max("ay").alias("n"))
    c0 = F.greatest(F.ceil((F.col("w") - F.lit(meta.x0)) / F.lit(meta.dx) - 0.5), F.lit(0))
    c1 = F.least(F.floor((F.col("e") - F.lit(meta.x0)) / F.lit(meta.dx) - 0.5), F.lit(meta.n_cols - 1))
    r0 = F.greatest(F.ceil((F.lit(meta.y0) - F.col("n")) / F.lit(meta.dy) - 0.5), F.lit(0))
    r1 = F.least(F.floor((F.lit(meta.y0) - F.col("s")) / F.lit(meta.dy) - 0.5), F.lit(meta.n_rows - 1))
    return box.select(zone_col, r0.cast("long").alias("row0"), c0.cast("long").alias("col0"),
                      F.greatest(r1 - r0 + 1, F.lit(0)).cast("long").alias("n_rows"),
                      F.greatest(c1 - c0 + 1, F.lit(0)).cast("long").alias("n_cols"))


def target_grid_meta(spark, src: RasterMeta, dst_crs: str, n_cols: int | None = None,
                     n_rows: int | None = None) -> RasterMeta:
    """Target grid in ``dst_crs`` covering the projected source, with the
    source's shape by default.  The extremes are taken over all cell corners
    of the source's edge (a distributed range, one row per corner) and the
    points of the edge on a UTM zone's central meridian, where a parallel's
    northing turns."""
    w, s, e, n = src.bounds
    i = F.col("id").cast("double")
    along_x = spark.range(src.n_cols + 1).select((F.lit(w) + i * F.lit(src.dx)).alias("x"), F.explode(
        F.array(F.lit(s), F.lit(n))).alias("y"))
    along_y = spark.range(src.n_rows + 1).select(F.explode(F.array(F.lit(w), F.lit(e))).alias("x"),
                                                 (F.lit(s) + i * F.lit(src.dy)).alias("y"))
    edge = along_x.unionByName(along_y)
    if _epsg(src.crs) == 4326 and _epsg(dst_crs) != 4326:
        middle = geo.central_meridian(_utm_zone(dst_crs)[0])
        if w < middle < e:
            edge = edge.unionByName(spark.createDataFrame([(middle, s), (middle, n)], "x double, y double"))
    p = reproject_xy(F.col("x"), F.col("y"), src.crs, dst_crs)
    b = edge.select(p.alias("p")).agg(F.min("p.x").alias("w"), F.min("p.y").alias("s"),
                                      F.max("p.x").alias("e"), F.max("p.y").alias("n")).first()
    return RasterMeta.from_bounds(b["w"], b["s"], b["e"], b["n"], n_cols or src.n_cols,
                                  n_rows or src.n_rows, dst_crs, src.nodata)


def target_cells(spark, meta: RasterMeta, num_partitions: int | None = None) -> DataFrame:
    """All (row, col) of a grid, generated in parallel by ``spark.range``."""
    n = meta.n_rows * meta.n_cols
    ids = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(0, n)
    return ids.select((F.col("id") / meta.n_cols).cast("long").alias("row"),
                      (F.col("id") % meta.n_cols).alias("col"))


def raster_nearest(src: Raster, dst: RasterMeta) -> DataFrame:
    """Resample to grid ``dst`` by nearest: each target cell centre is mapped
    back into the source CRS and takes the containing source cell's value."""
    spark = src.cells.sparkSession
    t = target_cells(spark, dst)
    t = t.withColumn("_x", cell_center_x("col", dst)).withColumn("_y", cell_center_y("row", dst))
    p = reproject_xy(F.col("_x"), F.col("_y"), dst.crs, src.meta.crs)
    t = t.withColumn("_srow", cell_of_y(p["y"], src.meta)).withColumn("_scol", cell_of_x(p["x"], src.meta))
    s = raster_valid(src).select(F.col("row").alias("_srow"), F.col("col").alias("_scol"), "value")
    return t.join(s, ["_srow", "_scol"]).select("row", "col", "value")


def raster_bilinear(src: Raster, dst: RasterMeta) -> DataFrame:
    """Resample to grid ``dst`` bilinearly.  Each target centre maps to a
    continuous source position; its 4 surrounding source centres are
    exploded with their weights, equi-joined to the source cells, and
    ``sum(w * v) / sum(w)`` renormalises over the neighbours that exist
    (so edges and nodata holes do not pull values towards 0)."""
    spark = src.cells.sparkSession
    t = target_cells(spark, dst)
    t = t.withColumn("_x", cell_center_x("col", dst)).withColumn("_y", cell_center_y("row", dst))
    p = reproject_xy(F.col("_x"), F.col("_y"), dst.crs, src.meta.crs)
    fc = (p["x"] - F.lit(src.meta.x0)) / F.lit(src.meta.dx) - F.lit(0.5)
    fr = (F.lit(src.meta.y0) - p["y"]) / F.lit(src.meta.dy) - F.lit(0.5)
    t = t.withColumn("_fc", fc).withColumn("_fr", fr) \
         .withColumn("_c0", F.floor("_fc")).withColumn("_r0", F.floor("_fr"))
    corners = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (0, 1) for b in (0, 1)])
    t = t.select("row", "col", "_fc", "_fr", "_c0", "_r0", F.explode(corners).alias("_k"))
    tc = F.col("_fc") - F.col("_c0")
    tr = F.col("_fr") - F.col("_r0")
    wc = F.when(F.col("_k.dc") == 1, tc).otherwise(F.lit(1.0) - tc)
    wr = F.when(F.col("_k.dr") == 1, tr).otherwise(F.lit(1.0) - tr)
    t = t.select("row", "col", (F.col("_r0") + F.col("_k.dr")).alias("_srow"),
                 (F.col("_c0") + F.col("_k.dc")).alias("_scol"), (wc * wr).alias("_w"))
    s = raster_valid(src).select(F.col("row").alias("_srow"), F.col("col").alias("_scol"), "value")
    j = t.join(s, ["_srow", "_scol"])
    g = j.groupBy("row", "col").agg(F.sum(F.col("_w") * F.col("value")).alias("_wv"), F.sum("_w").alias("_ws"))
    return g.where(F.col("_ws") > 0).select("row", "col", (F.col("_wv") / F.col("_ws")).alias("value"))


def raster_blocks(r: Raster, block: int = 512) -> DataFrame:
    """Storage blocks: per (block_row, block_col) cell count, value sum, min, max."""
    return (raster_valid(r)
            .groupBy(F.floor(F.col("row") / block).alias("block_row"),
                     F.floor(F.col("col") / block).alias("block_col"))
            .agg(F.count(F.lit(1)).alias("n_cells"), F.sum("value").alias("value_sum"),
                 F.min("value").alias("value_min"), F.max("value").alias("value_max")))


def _full_resolution(r: Raster) -> DataFrame:
    """Valid cells as the overview steps carry them: value or sum ``_v``, cells ``_n``, place of the nearest one ``_at``."""
    return raster_valid(r).select("row", "col", F.col("value").alias("_v"), F.lit(1).cast("long").alias("_n"),
                                  F.struct("row", "col").alias("_at"))


def _halved(now: DataFrame, how: str) -> DataFrame:
    """The level above: 2 x 2 cells merge into one."""
    g = now.groupBy(*[F.floor(F.col(c) / 2).alias(c) for c in ("row", "col")])
    if how == "avg":
        return g.agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"))
    return g.agg(F.min_by("_v", "_at").alias("_v"), F.min("_at").alias("_at"))


def raster_overviews(r: Raster, levels: int, how: str = "avg") -> dict[int, DataFrame]:
    """Reduced-resolution levels 1..levels, each made from the one before: 2 x 2
    cells merge into one.  ``avg`` averages the valid cells of full resolution
    (sums and counts travel along); ``nearest`` keeps the top-left valid one.
    Frames have (row, col, value)."""
    if how not in ("avg", "nearest"):
        raise ValueError(how)
    now, out = _full_resolution(r), {}
    for level in range(1, levels + 1):
        now = _halved(now, how)
        value = F.col("_v") / F.col("_n") if how == "avg" else F.col("_v")
        out[level] = now.select("row", "col", value.alias("value"))
    return out


def pyramid_levels(meta: RasterMeta, block: int) -> int:
    """Overview levels until one storage block holds the whole raster."""
    return max(0, math.ceil(math.log2(max(meta.n_rows, meta.n_cols, 1) / block)))


def write_pyramid(r: Raster, path: str, levels: int | None = None, how: str = "avg", block: int | None = None,
                  mode: str = "overwrite") -> dict[int, str]:
    """Store a raster and its overview levels; returns {level: path}.

    Level 0 is the raster itself, as ``write_raster`` stores it.  Level k lies in ``_overviews/k``
    beside its blocks (scans of ``path`` pass over it), in blocks of its own and with a header of
    its own, and is made from the stored level below, a quarter of its cells, so full resolution is
    read once.  ``_overviews/_levels`` lists the levels' headers for ``read_raster``.
    """
    if how not in ("avg", "nearest"):
        raise ValueError(how)
    spark, m, block = r.cells.sparkSession, r.meta, block or r.meta.block
    levels = pyramid_levels(m, block) if levels is None else levels
    paths, headers = {0: write_raster(r.cells, path, block, mode, m)}, [(0, m.with_shape(block=block))]
    now = _full_resolution(read_raster(spark, path))
    for level in range(1, levels + 1):
        scale = 2 ** level
        meta = m.with_shape(dx=m.dx * scale, dy=m.dy * scale, n_rows=math.ceil(m.n_rows / scale),
                            n_cols=math.ceil(m.n_cols / scale), nodata=None, block=block)   # valid cells only: any value may stand
        up = _halved(now, how)
        value = F.col("_v") / F.col("_n") if how == "avg" else F.col("_v")
        kept = ["_v", "_n"] if how == "avg" else ["_v", "_at"]
        paths[level] = write_raster(up.withColumn("value", value), f"{path}/_overviews/{level}", block, mode, meta, kept)
        now = spark.read.parquet(paths[level]).select("row", "col", *kept)
        headers.append((level, meta))
    rows = [(level, *vars(meta).values()) for level, meta in headers]
    spark.createDataFrame(rows, "level int, " + HEADER_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{path}/_overviews/_levels")
    return paths


def raster_overview(r: Raster, level: int, how: str = "avg") -> DataFrame:
    """One reduced-resolution level: 2^level x 2^level cells merge into one."""
    return raster_overviews(r, level, how)[level]
