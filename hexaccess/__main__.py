"""Command line: run the pipeline (or one stage) and write its outputs.

    python -m hexaccess pipeline --admin <parquet> --facilities <parquet or geojson> \\
        --population <raster> --flood <raster> --bbox 27.3 -4.5 29.1 -3.5 --crs EPSG:32735 --out /shared/run1
    python -m hexaccess pipeline --sf-dir /root/testdata/sf0.1 --out /shared/run1    # inputs made from the test tables
    python -m hexaccess grid|exposure|accessibility|priority --sf-dir ... --out ...
    python -m hexaccess query <key> --sf-dir ... [--out ...]     # any registered query

Rasters are cell tables with their header (``sinks.writers.write_raster``).
The pipeline writes Parquet (zstd) layers with bounding boxes, tile tables, the
exposed-population raster, line-delimited GeoJSON and a manifest.  ``--method network --roads <parquet>`` measures
distances along roads.  ``--mode ignore`` keeps outputs that already exist.  The session is the caller's (under
spark-submit the cluster's); stage tables are deleted at the end of a written run.
"""

from __future__ import annotations

import argparse
import sys


def _params(args):
    from hexaccess.params import Params
    box = dict(zip(("west", "south", "east", "north"), args.bbox)) if args.bbox else {}
    extra = {k: v for k, v in (("analysis_crs", args.crs), ("country_code", args.country), ("study_name", args.study),
                               ("min_zoom", args.min_zoom), ("max_zoom", args.max_zoom)) if v is not None}
    return Params(**box, **extra, resolution=args.resolution, threshold_km=args.threshold_km, moderate_km=args.moderate_km,
                  exposure_weight=args.exposure_weight, accessibility_weight=args.accessibility_weight,
                  top_percentile=args.top_percentile)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="hexaccess")
    ap.add_argument("command", choices=["pipeline", "grid", "exposure", "accessibility", "priority", "query"])
    ap.add_argument("key", nargs="?", help="query key for the 'query' command")
    ap.add_argument("--sf-dir", help="test tables from which inputs are made; or name the four inputs:")
    for name in ("admin", "facilities", "population", "flood"):
        ap.add_argument(f"--{name}")
    ap.add_argument("--method", default="straight", choices=["straight", "network"], help="distance to facilities: straight line, or along --roads")
    ap.add_argument("--roads", help="Parquet of road lines: id, line (array of lon/lat points x, y)")
    ap.add_argument("--bbox", nargs=4, type=float, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    ap.add_argument("--crs", help="analysis CRS, a UTM zone as EPSG code")
    ap.add_argument("--country")
    ap.add_argument("--study", help="name of the study in the manifest")
    ap.add_argument("--min-zoom", type=int)
    ap.add_argument("--max-zoom", type=int)
    ap.add_argument("--out")
    ap.add_argument("--mode", default="overwrite", choices=["overwrite", "ignore"])
    ap.add_argument("--resolution", type=int, default=6)
    ap.add_argument("--threshold-km", type=float, default=5.0)
    ap.add_argument("--moderate-km", type=float, default=10.0)
    ap.add_argument("--exposure-weight", type=float, default=0.6)
    ap.add_argument("--accessibility-weight", type=float, default=0.4)
    ap.add_argument("--top-percentile", type=float, default=10.0)
    args = ap.parse_args(argv)

    from datetime import datetime, timezone

    from hexaccess.plans import jobs
    from hexaccess.session import current_session, drop_stage_tables
    from hexaccess.sinks.outputs import write_outputs
    from hexaccess.sinks.writers import write_table
    paths = [args.admin, args.facilities, args.population, args.flood]
    if not args.sf_dir and (args.command == "query" or not all(paths)):
        ap.error("name --sf-dir, or all of --admin --facilities --population --flood")
    if args.method == "network" and not args.roads:
        ap.error("--method network needs --roads")
    spark = current_session()
    p = _params(args)

    if args.command == "query":
        from hexaccess.plans.registry import QUERIES
        df = QUERIES[args.key](spark, args.sf_dir)
        if args.out:
            write_table(df, args.out, mode=args.mode)
        else:
            df.show(50, truncate=False)
        return 0

    inputs = jobs.load_inputs_from(spark, *paths, p) if all(paths) else jobs.load_inputs(spark, args.sf_dir, p)
    by_road = args.method == "network" and args.command in ("pipeline", "accessibility", "priority")
    network = jobs.road_network(spark.read.parquet(args.roads), p) if by_road else None
    if args.command == "pipeline":
        outs = jobs.pipeline_from_inputs(inputs, p, network)
    else:
        g = jobs.build_grid(inputs.admin, p)
        if args.command in ("exposure", "accessibility", "priority"):
            g = jobs.exposure(g, inputs.population, inputs.flood, p)
        if args.command in ("accessibility", "priority"):
            g = jobs.accessibility(g, inputs.facilities, p, network=network)
        if args.command == "priority":
            g = jobs.priority(g, p)
        outs = {"grid": g}
    if not args.out:
        jobs.to_lonlat_grid(outs["grid"], p).drop("geometry").show(20, truncate=False)
        return 0
    base = args.out.rstrip("/")
    if args.command == "pipeline":
        created = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        write_outputs(outs, inputs.population, inputs.flood, p, base, created, args.mode).select("asset", "n_rows", "path").show(50, truncate=False)
    else:
        write_table(jobs.to_lonlat_grid(outs["grid"], p), f"{base}/grid", mode=args.mode, compression=p.compression)
    print(f"wrote {', '.join(outs)} under {base}")
    drop_stage_tables(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
