"""Density clusters of points in the plane for a fixed radius.

A point is core when at least ``min_pts`` points (itself and copies included) lie
within ``eps``; core points within ``eps`` of each other share a cluster, other
points within ``eps`` of a core point border it, the rest is noise.

No pairs of points are listed.  The plane is cut into cells whose diagonal is
below ``eps``, so a cell's points always belong together: a cell with ``min_pts``
points is core as a whole and clusters are components of *cells*.  Where single
distances matter, boxes are compared instead of points, and only boxes that
straddle the radius are quartered and compared again.  Points in the same place
are one position with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.operators.ranking import sequential_id
from cuadrante.session import pin

FEW_PAIRS = 256  # pairs of positions that two boxes may compare one by one
MAX_DEPTH = 60


def _box(x: str, y: str, side: float, level: int) -> list[Column]:
    unit = F.lit(side / 2**level)
    return [F.floor(F.col(x) / unit).alias("qx"), F.floor(F.col(y) / unit).alias("qy")]


def _boxes(points: DataFrame, node: str, side: float, level: int, prefix: str) -> DataFrame:
    """Tight bounds, positions and weight of each occupied box of a node."""
    out = points.groupBy(node, *_box("x", "y", side, level)).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"),
    )
    return out.select(node, *[F.col(c).alias(f"{prefix}{c}") for c in out.columns if c != node])


def _square(a: Column) -> Column:
    return a * a


def _nearest2(a: str, b: str) -> Column:
    """Least squared distance of two boxes."""

    def gap(lo: str, hi: str) -> Column:
        return F.greatest(F.lit(0.0), F.col(a + lo) - F.col(b + hi), F.col(b + lo) - F.col(a + hi))

    return _square(gap("x0", "x1")) + _square(gap("y0", "y1"))


def _farthest2(a: str, b: str) -> Column:
    """Greatest squared distance of two boxes."""

    def reach(lo: str, hi: str) -> Column:
        return F.greatest(F.abs(F.col(a + hi) - F.col(b + lo)), F.abs(F.col(b + hi) - F.col(a + lo)))

    return _square(reach("x0", "x1")) + _square(reach("y0", "y1"))


def _parent(q: str) -> Column:
    return F.floor(F.col(q) / F.lit(2)).cast("bigint")


def _points_in_boxes(points: DataFrame, node: str, side: float, level: int, prefix: str) -> DataFrame:
    return points.select(
        node, *[c.alias(f"{prefix}{q}") for c, q in zip(_box("x", "y", side, level), ("qx", "qy"))],
        F.col("x").alias(f"{prefix}x"), F.col("y").alias(f"{prefix}y"), F.col("n").alias(f"{prefix}n"),
    )


def _touching(pairs: DataFrame, left: DataFrame, right: DataFrame, eps: float, side: float,
              few: int = FEW_PAIRS) -> DataFrame:
    """Those pairs (l, r) of nodes that have positions within ``eps``.

    ``left`` and ``right`` hold the nodes' positions.  Boxes wholly inside the
    radius settle a pair, boxes wholly outside drop out, and of the rest the
    small ones are compared position by position, the large ones quartered.
    """
    reach2 = F.lit(eps * eps)
    settled: list[DataFrame] = []
    frontier, level = pairs.select("l", "r"), 0
    while True:
        lb, rb = _boxes(left, "l", side, level, "a"), _boxes(right, "r", side, level, "b")
        if level == 0:
            met = frontier.join(lb, "l").join(rb, "r")
        else:
            lb = lb.withColumns({"_apx": _parent("aqx"), "_apy": _parent("aqy")})
            rb = rb.withColumns({"_bpx": _parent("bqx"), "_bpy": _parent("bqy")})
            met = frontier.join(lb, ["l", "_apx", "_apy"]).join(rb, ["r", "_bpx", "_bpy"])
        near = pin(
            met.filter(_nearest2("a", "b") <= reach2).withColumn("_sure", _farthest2("a", "b") <= reach2)
        )
        sure = near.filter("_sure").select("l", "r").distinct()
        open_ = near.join(sure, ["l", "r"], "left_anti")
        small = F.col("am") * F.col("bm") <= F.lit(few)
        boxes = ["l", "r", "aqx", "aqy", "bqx", "bqy"]
        compared = (
            open_.filter(small).select(*boxes)
            .join(_points_in_boxes(left, "l", side, level, "a"), ["l", "aqx", "aqy"])
            .join(_points_in_boxes(right, "r", side, level, "b"), ["r", "bqx", "bqy"])
            .filter(_square(F.col("ax") - F.col("bx")) + _square(F.col("ay") - F.col("by")) <= reach2)
            .select("l", "r").distinct()
        )
        done = sure.unionByName(compared)
        settled.append(done)
        if near.filter(~F.col("_sure")).filter(~small).isEmpty():
            break
        done = settled[-1] = pin(done)
        rest = pin(
            open_.filter(~small).join(done, ["l", "r"], "left_anti").select(
                "l", "r", F.col("aqx").alias("_apx"), F.col("aqy").alias("_apy"),
                F.col("bqx").alias("_bpx"), F.col("bqy").alias("_bpy"),
            )
        )
        if rest.isEmpty():
            break
        level += 1
        if level > MAX_DEPTH:
            raise RuntimeError("positions are closer than doubles can tell apart")
        frontier = rest
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.distinct()


def _crowded(pairs: DataFrame, probes: DataFrame, positions: DataFrame, need: int, eps: float, side: float,
             few: int = FEW_PAIRS) -> DataFrame:
    """Probes (l) with at least ``need`` points within ``eps``; the other node of
    each pair is a cell (r) that may hold some of them."""
    reach2 = F.lit(eps * eps)
    found: list[DataFrame] = []
    probe = probes.select("l", *[F.col(c).alias(f"a{c}{i}") for c in ("x", "y") for i in (0, 1)])
    tally = probes.select("l").withColumn("have", F.lit(0).cast("bigint"))
    frontier, level = pairs.select("l", "r"), 0
    while True:
        boxes = _boxes(positions, "r", side, level, "b")
        if level == 0:
            met = frontier.join(boxes, "r")
        else:
            boxes = boxes.withColumns({"_bpx": _parent("bqx"), "_bpy": _parent("bqy")})
            met = frontier.join(boxes, ["r", "_bpx", "_bpy"])
        near = pin(
            met.join(probe, "l").filter(_nearest2("a", "b") <= reach2)
            .withColumns({"_sure": _farthest2("a", "b") <= reach2, "_small": F.col("bm") <= F.lit(few)})
        )
        exact = (
            near.filter("NOT _sure AND _small").select("l", "r", "bqx", "bqy", "ax0", "ay0")
            .join(_points_in_boxes(positions, "r", side, level, "b"), ["r", "bqx", "bqy"])
            .filter(_square(F.col("ax0") - F.col("bx")) + _square(F.col("ay0") - F.col("by")) <= reach2)
            .groupBy("l").agg(F.sum("bn").alias("exact"))
        )
        sums = near.groupBy("l").agg(
            F.sum(F.when(F.col("_sure"), F.col("bw")).otherwise(F.lit(0))).alias("inside"),
            F.sum(F.when(~F.col("_sure") & ~F.col("_small"), F.col("bw")).otherwise(F.lit(0))).alias("maybe"),
        )
        zero = F.lit(0).cast("bigint")
        counted = (
            tally.join(sums, "l", "left").join(exact, "l", "left").select(
                "l",
                (F.col("have") + F.coalesce("inside", zero) + F.coalesce("exact", zero)).alias("have"),
                F.coalesce("maybe", zero).alias("maybe"),
            )
        )
        found.append(counted.filter(F.col("have") >= need).select("l"))
        if near.filter("NOT _sure AND NOT _small").isEmpty():
            break
        counted = pin(counted)
        found[-1] = counted.filter(F.col("have") >= need).select("l")
        tally = counted.filter((F.col("have") < need) & (F.col("have") + F.col("maybe") >= need)).select("l", "have")
        rest = pin(
            near.filter("NOT _sure AND NOT _small").join(tally, "l", "left_semi").select(
                "l", "r", F.col("bqx").alias("_bpx"), F.col("bqy").alias("_bpy")
            )
        )
        if rest.isEmpty():
            break
        level += 1
        if level > MAX_DEPTH:
            raise RuntimeError("positions are closer than doubles can tell apart")
        frontier = rest
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least label of each connected component.

    ``nodes`` is (node, label) with labels unique, ``edges`` is (l, r) of nodes.
    Every round links the larger neighbours of each label to its least one, then
    the smaller ones, which turns components into stars around their least label
    in a logarithmic number of rounds (Kiveris et al., "Connected Components in
    MapReduce and Beyond").  Only least neighbours are aggregated and joined
    back, so the growing stars are never gathered.
    """
    left = nodes.select(F.col("node").alias("l"), F.col("label").alias("u"))
    right = nodes.select(F.col("node").alias("r"), F.col("label").alias("v"))
    links = pin(edges.join(left, "l").join(right, "r").select("u", "v").filter("u <> v").distinct())
    while True:  # every round that changes a link lowers a label, so it settles
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u").join(least, "u")
            .select(F.greatest("v", F.least("u", "m")).alias("u"), F.least("u", "m").alias("v"))
            .filter("u <> v").distinct()
        )
        # Now u > v throughout: link each label's smaller neighbours to the least.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = pin(
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        # Stars: every label has one link, and none leads to a label with a link.
        several = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        deeper = links.select(F.col("v").alias("u")).join(links.select("u"), "u", "left_semi")
        if several.unionByName(deeper).isEmpty():
            centre = links.select(F.col("u").alias("label"), F.col("v").alias("_centre"))
            return nodes.join(centre, "label", "left").select(
                "node", F.coalesce("_centre", "label").alias("label")
            )


def _cell(dx: Column | int = 0, dy: Column | int = 0) -> Column:
    return F.concat_ws(":", (F.col("cx") + dx).cast("string"), (F.col("cy") + dy).cast("string"))


def density_clusters(
    df: DataFrame, key: str, x: str, y: str, eps: float, min_pts: int, min_size: int = 1, name: str = "cluster",
    few: int = FEW_PAIRS,
) -> DataFrame:
    """Cluster number of every row: 1, 2, ... by the clusters' least core key; 0
    for noise and for clusters of fewer than ``min_size`` points.

    A border point of several clusters goes to the one with the least core key.
    Run it twice (say 5 points and size 15, then 20 and 200) for a micro and a
    macro level.
    """
    side = eps / 2**0.5 * (1 - 1e-9)
    unit = F.lit(side)
    positions = pin(
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
        .withColumns({"cx": F.floor(F.col("x") / unit), "cy": F.floor(F.col("y") / unit)})
        .withColumns({"r": _cell(), "l": F.concat_ws(":", F.col("x").cast("string"), F.col("y").cast("string"))})
    )
    around = F.array(
        *[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in range(-2, 3) for j in range(-2, 3)]
    )
    counts = positions.groupBy("r").agg(F.sum("n").alias("cell_n"))
    sized = pin(positions.join(counts, "r"))
    sparse = sized.filter(F.col("cell_n") < min_pts)
    probes = sparse.select("l", "x", "y", "n")
    cells_near = sparse.withColumn("o", F.explode(around)).select("l", _cell(F.col("o.dx"), F.col("o.dy")).alias("r"))
    crowded = _crowded(cells_near, probes, positions, min_pts, eps, side, few)
    core = pin(
        sized.filter(F.col("cell_n") >= min_pts).unionByName(sparse.join(crowded, "l", "left_semi"))
        .select("x", "y", "n", "first", "cx", "cy", F.col("r").alias("node"), "l")
    )

    nodes = core.groupBy("node", "cx", "cy").agg(F.min("first").alias("label"))
    half = F.filter(around, lambda o: (o["dx"] > 0) | ((o["dx"] == 0) & (o["dy"] > 0)))
    ahead = nodes.withColumn("o", F.explode(half)).select(
        F.col("node").alias("l"), _cell(F.col("o.dx"), F.col("o.dy")).alias("r")
    )
    pairs = ahead.join(nodes.select(F.col("node").alias("r")), "r", "left_semi")
    core_points = core.select("node", "x", "y", "n")
    edges = _touching(
        pairs, core_points.withColumnRenamed("node", "l"), core_points.withColumnRenamed("node", "r"), eps, side, few
    )
    labels = pin(components(nodes, edges))

    loose = pin(sparse.join(core, "l", "left_anti"))
    border_pairs = (
        loose.withColumn("o", F.explode(around)).select("l", _cell(F.col("o.dx"), F.col("o.dy")).alias("r"))
        .join(labels.select(F.col("node").alias("r")), "r", "left_semi")
    )
    bordering = _touching(
        border_pairs, loose.select("l", "x", "y", "n"), core_points.withColumnRenamed("node", "r"), eps, side, few
    )
    border_labels = bordering.join(labels.withColumnRenamed("node", "r"), "r").groupBy("l").agg(
        F.min("label").alias("label")
    )
    labelled = core.join(labels, "node").select("x", "y", "n", "label").unionByName(
        loose.join(border_labels, "l").select("x", "y", "n", "label")
    )
    labelled = pin(labelled)
    sizes = labelled.groupBy("label").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_size)
    numbered = sequential_id(sizes.select("label"), "label", name="_cluster")
    placed = labelled.join(numbered, "label").select(F.col("x").alias("_x"), F.col("y").alias("_y"), "_cluster")
    match = (F.col(x).cast("double") == F.col("_x")) & (F.col(y).cast("double") == F.col("_y"))
    return df.join(placed, match, "left").withColumn(
        name, F.coalesce(F.col("_cluster"), F.lit(0)).cast("bigint")
    ).drop("_x", "_y", "_cluster")


def cluster_summary(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Clusters (noise not counted), rows in clusters, rows of noise."""
    return df.agg(
        F.count_distinct(F.when(F.col(label) > 0, F.col(label))).alias("n_clusters"),
        F.count_if(F.col(label) > 0).alias("n_clustered"),
        F.count_if(F.col(label) == 0).alias("n_noise"),
    )
