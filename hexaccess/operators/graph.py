"""Road graph: edge table from segments and multi-source network distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexaccess.functions import geo
from hexaccess.session import materialise


def snap_node(x, y, tol: float):
    """Node id of an end point snapped to a ``tol`` grid (metres)."""
    return F.concat_ws("_", F.round(geo._c(x) / F.lit(tol)).cast("long").cast("string"),
                       F.round(geo._c(y) / F.lit(tol)).cast("long").cast("string"))


def road_edges(segments: DataFrame, tol: float = 0.001, zone: int = 35, south: bool = True,
               line: str = "line", seg_id: str = "id") -> DataFrame:
    """G1: (id, source, target, length_m, cost) from lon/lat lines.  Each
    line is projected and measured inside its own row (no shuffle); end
    points snap to a ``tol``-metre grid to form node ids."""
    v = geo.ring_to_utm(F.col(line), zone, south)
    n = F.size(F.col("_v"))
    length = F.aggregate(
        F.sequence(F.lit(0), n - 2), F.lit(0.0),
        lambda acc, k: acc + geo.distance(F.get(F.col("_v"), k)["x"], F.get(F.col("_v"), k)["y"],
                                          F.get(F.col("_v"), k + 1)["x"], F.get(F.col("_v"), k + 1)["y"]))
    first, last = F.get(F.col("_v"), 0), F.get(F.col("_v"), n - 1)
    return segments.select(F.col(seg_id).alias("id"), v.alias("_v")).select(
        "id", snap_node(first["x"], first["y"], tol).alias("source"),
        snap_node(last["x"], last["y"], tol).alias("target"),
        length.alias("length_m"), length.alias("cost"))


def road_nodes(segments: DataFrame, tol: float = 0.001, zone: int = 35, south: bool = True, line: str = "line") -> DataFrame:
    """(node, x, y): the projected end points of lon/lat lines, snapped as by ``road_edges``; lines between them are no nodes."""
    v = F.col(line)
    ends = segments.where(F.size(v) >= 2).select(F.explode(F.array(F.get(v, 0), F.get(v, F.size(v) - 1))).alias("_p"))
    ends = geo.with_utm(ends.select(F.col("_p.x").alias("lon"), F.col("_p.y").alias("lat")), "lon", "lat", "x", "y", zone, south)
    return ends.groupBy(snap_node(F.col("x"), F.col("y"), tol).alias("node")).agg(F.min("x").alias("x"), F.min("y").alias("y"))


HOPS = 3                    # pointers followed per written table, so a chain's reach grows by 4
SPREAD = 32                 # of the inner nodes of a large table, one in so many is kept for the next level
MANY_NODES = 20_000         # inner nodes from which a level keeps some


def _undirected(edges: DataFrame) -> DataFrame:
    """(a, b, cost): both directions of every edge, the cheapest of parallel ones, no loops."""
    both = edges.select(F.col("source").alias("a"), F.col("target").alias("b"), "cost").unionByName(
        edges.select(F.col("target").alias("a"), F.col("source").alias("b"), "cost"))
    return both.where(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.min("cost").alias("cost"))


def _numbered(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(node, number): every node of the edges and sources with a number of its own, not negative."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("node"))
    return materialise(ends.unionByName(sources.select("node")).distinct().withColumn("number", F.monotonically_increasing_id()), "graph_numbers")


def _inner(darts: DataFrame, sources: DataFrame, level: int) -> tuple[DataFrame, bool]:
    """Inner nodes (_v, its neighbours _x and _y): two neighbours and no source; and whether some were kept out.

    Of many, a share picked by a hash of the level's own is kept out, so the chains between them are short (in the mean SPREAD edges)."""
    nodes = darts.groupBy("a").agg(F.count(F.lit(1)).alias("_n"), F.min("b").alias("_x"), F.max("b").alias("_y"))
    inner = materialise(nodes.where("_n = 2").join(sources.select(F.col("node").alias("a")), "a", "left_anti")
                        .select(F.col("a").alias("_v"), "_x", "_y", (F.pmod(F.xxhash64(F.lit(level), "a"), F.lit(SPREAD)) == 0).alias("_kept")), "graph_inner")
    some = inner.count() > MANY_NODES
    return (inner.where("NOT _kept") if some else inner).drop("_kept"), some


def _chains(darts: DataFrame, inner: DataFrame) -> DataFrame:
    """(a, b, end, cost, inner): for every dart (a, b), a directed edge, the first node behind it that is no inner one and
    the cost to get there; ``inner`` tells whether a is inner itself.  Nodes are numbers, not negative.

    Each dart into an inner node points to the dart that leaves it on the other side.  A written table follows HOPS
    pointers of the table before, so a chain of n edges takes log4(n) of them.  Only darts that still point
    somewhere are written again; one that points nowhere has a key that no dart has (``na`` below 0), and not null,
    so that joins spread such darts.  Rings without an end never reach one and are left out.
    """
    out = F.when(F.col("_x") == F.col("a"), F.col("_y")).otherwise(F.col("_x"))
    nowhere = -1 - F.col("a")
    now = materialise(
        darts.join(inner, F.col("b") == F.col("_v"), "left")
        .select("a", "b", F.col("b").alias("end"), "cost", F.when(F.col("_v").isNotNull(), F.col("_v")).otherwise(nowhere).alias("na"),
                F.when(F.col("_v").isNotNull(), out).otherwise(F.col("b")).alias("nb"))
        .join(inner.select(F.col("_v").alias("a"), F.lit(True).alias("inner")), "a", "left").withColumn("inner", F.coalesce("inner", F.lit(False))),
        "graph_chains")
    done, left = now.where("na < 0"), now.where("na >= 0")
    waiting = left.count()
    tables = max(1, waiting).bit_length() // 2 + 2       # enough for one chain of all darts; what waits then is a ring
    while waiting and tables:
        known = done.unionByName(left).where("inner")
        ahead = known.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("end").alias("_end"), F.col("cost").alias("_cost"),
                             F.col("na").alias("_na"), F.col("nb").alias("_nb"))
        now = left
        for _ in range(HOPS):
            go = F.col("_end").isNotNull()
            now = now.join(ahead, ["na", "nb"], "left").select(
                "a", "b", F.coalesce("_end", "end").alias("end"), F.when(go, F.col("cost") + F.col("_cost")).otherwise(F.col("cost")).alias("cost"),
                F.when(go & (F.col("_na") >= 0), F.col("_na")).when(~go & (F.col("na") >= 0), F.col("na")).otherwise(nowhere).alias("na"),
                F.when(go, F.col("_nb")).otherwise(F.col("nb")).alias("nb"), "inner")
        now = materialise(now, "graph_chains")
        done, left = done.unionByName(now.where("na < 0")), now.where("na >= 0")
        waiting, tables = left.count(), tables - 1
    return done.select("a", "b", "end", "cost", "inner")


def network_distance(edges: DataFrame, sources: DataFrame, node: str = "node", delta: float | None = None) -> DataFrame:
    """Shortest network cost from the nearest source node to every reachable node (edges undirected, costs
    not negative).  Sources start at 0, or at their ``dist`` where they have one.

    Nodes are numbered, so rounds carry and compare numbers only.  Chains of inner nodes are contracted to one edge
    (``_chains``), in levels: while a level has many inner nodes, a share of them is kept, so its chains are short
    whatever the length of the roads, and the next level, a small part of its size, contracts the kept ones.
    On what is left, nodes are settled in buckets of
    width ``delta`` (four mean costs): nodes of the nearest bucket are relaxed until none of them improves, then
    they are final, written once and not looked at again; only the nodes that wait, a front around the settled ones, are
    rewritten in a round.  Inner nodes get the better of the two ways along their chain at the end, in one join a level,
    the last level first.
    Every round is a written table under the shared checkpoint folder, so a lost executor costs one round.
    """
    named = sources.withColumn("node", F.col(node))
    numbers = _numbered(edges, named)
    start = F.min("dist") if "dist" in sources.columns else F.lit(0.0)
    by_name = numbers.withColumnRenamed("node", "_name")
    starts = materialise(named.groupBy("node").agg(start.cast("double").alias("dist")).join(by_name, F.col("node").eqNullSafe(F.col("_name")))
                         .select(F.col("number").alias("node"), "dist"), "graph_starts")
    at = lambda end: numbers.select(F.col("node").alias(end), F.col("number").alias(f"_{end}"))
    links = materialise(_undirected(edges.select("source", "target", "cost").join(at("source"), "source").join(at("target"), "target")
                                    .select(F.col("_source").alias("source"), F.col("_target").alias("target"), "cost")), "graph_darts")
    levels, some = [], True
    while some:
        inner, some = _inner(links, starts, len(levels))
        chains = _chains(links, inner)
        levels.append(chains.where("inner"))
        links = materialise(chains.where("NOT inner AND a <> end").groupBy("a", F.col("end").alias("b")).agg(F.min("cost").alias("cost")), "graph_links")
    width = delta or 4.0 * (links.agg(F.avg("cost")).first()[0] or 0.0)
    waiting, settled = starts.withColumn("relaxed", F.lit(False)), None
    while True:
        # the nearest bucket that holds a node, and whether one of its nodes is still to be relaxed
        near, open_from = waiting.agg(F.min("dist"), F.min(F.when(~F.col("relaxed"), F.col("dist")))).first()
        if near is None:
            break
        bound = near + width
        if open_from is None or open_from > bound:
            final = materialise(waiting.where(F.col("dist") <= bound).select("node", "dist"), "graph_settled")
            settled = final if settled is None else settled.unionByName(final)
            waiting = materialise(waiting.where(F.col("dist") > bound), "graph_waiting")
            continue
        front = waiting.where((F.col("dist") <= bound) & ~F.col("relaxed"))
        found = (front.join(links, front.node == links.a).select(F.col("b").alias("node"), (F.col("dist") + F.col("cost")).alias("dist"))
                 .groupBy("node").agg(F.min("dist").alias("dist")))
        if settled is not None:
            found = found.join(settled.select("node"), "node", "left_anti")
        # of equal distances the relaxed one stays, so nothing is relaxed twice at the same distance
        tried = waiting.select("node", "dist", (F.col("relaxed") | (F.col("dist") <= bound)).alias("relaxed"))
        waiting = materialise(tried.unionByName(found.withColumn("relaxed", F.lit(False))).groupBy("node").agg(
            F.min(F.struct("dist", (~F.col("relaxed")).alias("open"))).alias("_best")).select(
            "node", F.col("_best.dist").alias("dist"), (~F.col("_best.open")).alias("relaxed")), "graph_waiting")
    reached = starts if settled is None else settled
    for level in reversed(levels):
        ends = reached.select(F.col("node").alias("end"), "dist")
        along = level.join(ends, "end").groupBy(F.col("a").alias("node")).agg(F.min(F.col("dist") + F.col("cost")).alias("dist"))
        reached = reached.unionByName(along if level is levels[0] else materialise(along, "graph_along"))
    return reached.join(numbers.withColumnRenamed("node", "_name"), F.col("node") == F.col("number")).select(F.col("_name").alias("node"), "dist")


def network_access(points: DataFrame, facilities: DataFrame, edges: DataFrame, nodes: DataFrame,
                   point_id: str = "hex_id", px: str = "x", py: str = "y") -> DataFrame:
    """(point_id, nearest_facility_km) along the road network.

    ``nodes`` (node, x, y) are the ends of ``edges``.  Each facility is snapped to
    its nearest node, which starts at the facility's distance from it; costs
    relax over the network; each point takes its nearest node's cost and its
    own distance from that node.  A point whose node no facility reaches gets
    no row, like a point without facilities in the straight-line search.
    """
    from hexaccess.operators.nearest import nearest
    number = nodes.select(F.col("node").alias("_node"), F.xxhash64("node").alias("_id"), "x", "y")
    snap = lambda df, key, x, y: (nearest(df, number, point_id=key, px=x, py=y, fac_id="_id")
                                  .join(number.select("_id", "_node"), F.col("facility_id") == F.col("_id"))
                                  .select(key, F.col("_node").alias("node"), F.col("distance_m").alias("_own")))
    starts = (snap(facilities.select("id", "x", "y"), "id", "x", "y").groupBy("node").agg(F.min("_own").alias("dist")))
    reached = network_distance(edges, starts)
    mine = snap(points.select(point_id, px, py), point_id, px, py)
    return mine.join(reached, "node").select(point_id, ((F.col("dist") + F.col("_own")) / F.lit(1000.0)).alias("nearest_facility_km"))
