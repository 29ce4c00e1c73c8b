"""Density levels of points in the plane: core distances, the sparse graph that holds a
minimum spanning forest of mutual reachability, the forest, and its cuts.

The core distance of a point is that to its ``min_pts``-th nearest point, itself and
copies counted.  The mutual reachability of two points is the greatest of their
distance and their core distances.  Clusters of a level are what hangs together at its
``cut``; points whose core distance is greater are noise.

No pairs of whole neighbourhoods are listed.  Every point is linked to its nearest
points up to the greatest ``min_pts``, and in each of eight directions to the one point
``v`` with the least max(distance, core distance of ``v``).  For two points that are not
among each other's nearest, mutual reachability is their distance; a point ``z`` that
was taken in their direction instead is nearer to both, so both reach it at no greater
height.  Hence the links join at every height what all pairs would join, for every
``min_pts`` up to the greatest.

Both searches go from fine cells to cells twice as wide, and a point (or a direction of
a point) that has found its own takes no part any more.  A direction also ends when the
opposite one of its partner has: the partner's find is nearer to both.  So the inside of
a dense place is settled in fine cells and only its rim is compared in wide ones.

Tables with a row for each place or point are joined by sorting (``_sorted``), never sent
to all tasks through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadrante.operators.clusters import components
from cuadrante.operators.ranking import sequential_id
from cuadrante.session import pin

FINEST = 200  # halvings of the reach; doubles tell no more apart


class Level(NamedTuple):
    """One level of clusters."""

    name: str
    min_size: int
    min_pts: int
    cut: float


def _sorted(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast.

    Spark judges that by the size of files.  Places pack well there, and an exploded row
    counts as one, so tables of files below the threshold can have many times its bytes.
    """
    return df.hint("merge")


def _square(c: Column) -> Column:
    return c * c


def _apart2(a: str, b: str) -> Column:
    return _square(F.col(f"{b}.x") - F.col(f"{a}.x")) + _square(F.col(f"{b}.y") - F.col(f"{a}.y"))


def _in_cells(points: DataFrame, side: float) -> DataFrame:
    return points.withColumns({"cx": F.floor(F.col("x") / F.lit(side)), "cy": F.floor(F.col("y") / F.lit(side))})


def _spread(points: DataFrame, offsets: Column) -> DataFrame:
    """Each point under its own cell and those around it that ``offsets`` names."""
    moved = points.withColumn("_o", F.explode(offsets))
    return moved.withColumns({"cx": F.col("cx") + F.col("_o.dx"), "cy": F.col("cy") + F.col("_o.dy")}).drop("_o")


def _steps(xs: Sequence[int], ys: Sequence[int]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in xs for j in ys])


def _sides(positions: DataFrame, reach: float, few: int) -> list[float]:
    """Cell sides from one whose cells hold few positions up to ``reach``, doubling."""
    level = 0
    while level < FINEST:
        cells = _in_cells(positions, reach / 2**level).groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
        most = cells.agg(F.max("n")).first()[0] or 0
        if most <= few:
            break
        level += max(1, ((most + few - 1) // few).bit_length() // 2)
    return [reach / 2**k for k in range(min(level, FINEST), -1, -1)]


def nearest_positions(positions: DataFrame, k: int, reach: float, sides: Sequence[float]) -> DataFrame:
    """Each position ``p`` with ``near``: the places of its ``k`` nearest points within
    ``reach`` as (d2, p, n), itself first, by squared distance and then number.

    ``positions`` has p, x, y and n (points in the place).  A position is done at the first
    side within which it sees ``k`` points.
    """
    open_, done = positions, []
    for side in sides:
        seen = _spread(_in_cells(open_, side), _steps((-1, 0, 1), (-1, 0, 1))).alias("a")
        pairs = seen.join(_sorted(_in_cells(positions, side)).alias("b"), [F.col("a.cx") == F.col("b.cx"), F.col("a.cy") == F.col("b.cy")])
        d2 = _apart2("a", "b")
        pairs = pairs.filter(d2 <= side * side).select(F.col("a.p").alias("u"), d2.alias("d2"), F.col("b.p").alias("p"), F.col("b.n").alias("n"))
        first = Window.partitionBy("u").orderBy("d2", "p")
        near = pairs.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= k)
        near = near.groupBy("u").agg(F.array_sort(F.collect_list(F.struct("d2", "p", "n"))).alias("near"), F.sum("n").alias("_seen"))
        near = pin(near.withColumnRenamed("u", "p"))
        if side == sides[-1]:
            done.append(near.select("p", "near"))
            break
        done.append(near.filter(F.col("_seen") >= k).select("p", "near"))
        open_ = open_.join(_sorted(near.filter(F.col("_seen") < k).select("p")), "p", "left_semi")
        if near.filter(F.col("_seen") < k).isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _core2(k: int) -> Column:
    """The squared distance at which the nearest places hold ``k`` points, null if they do not."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("d2"))

    def take(acc: Column, x: Column) -> Column:
        n = acc["n"] + x["n"]
        return F.struct(n.alias("n"), F.when(acc["d2"].isNotNull(), acc["d2"]).when(n >= k, x["d2"]).alias("d2"))

    return F.aggregate("near", start, take)["d2"]


def _direction() -> Column:
    """Which of eight directions, of 45 degrees each, leads from a to b; turned around it
    is four more or less."""
    dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    return (
        F.when((dx > 0) & (dy >= 0), F.when(dy < dx, 0).otherwise(1))
        .when((dx <= 0) & (dy > 0), F.when(-dx < dy, 2).otherwise(3))
        .when((dx < 0) & (dy <= 0), F.when(dy > dx, 4).otherwise(5))
        .otherwise(F.when(dx < -dy, 6).otherwise(7))
    )


def _links_by_direction(nodes: DataFrame, sides: Sequence[float]) -> DataFrame:
    """Links (l, r, d2) of each of ``nodes`` (p, x, y, core2) in each direction."""
    quarters = [_steps((0, 1), (0, 1)), _steps((-1, 0), (0, 1)), _steps((-1, 0), (-1, 0)), _steps((0, 1), (-1, 0))]
    around = F.when(F.col("c") < 2, quarters[0]).when(F.col("c") < 4, quarters[1]).when(F.col("c") < 6, quarters[2]).otherwise(quarters[3])
    open_ = nodes.withColumn("c", F.explode(F.array(*[F.lit(c) for c in range(8)])))
    links = []
    for side in sides:
        placed = _in_cells(open_, side)
        back = placed.withColumn("c", (F.col("c") + 4) % 8).alias("b")
        pairs = _spread(placed, around).alias("a").join(_sorted(back), [F.col(f"a.{q}") == F.col(f"b.{q}") for q in ("cx", "cy", "c")])
        d2 = _apart2("a", "b")
        m2 = F.greatest(d2, F.col("b.core2"))
        pairs = pairs.filter((F.col("a.p") != F.col("b.p")) & (m2 <= side * side) & (_direction() == F.col("a.c")))
        best = pairs.groupBy(F.col("a.p").alias("l"), F.col("a.c").alias("c")).agg(F.min(F.struct(m2.alias("m2"), d2.alias("d2"), F.col("b.p").alias("r"))).alias("_v"))
        found = pin(best.select("l", "c", F.col("_v.r").alias("r"), F.col("_v.d2").alias("d2")))
        links.append(found.select("l", "r", "d2"))
        if side == sides[-1]:
            break
        open_ = pin(open_.join(_sorted(found.select(F.col("l").alias("p"), "c")), ["p", "c"], "left_anti"))
    out = links[0]
    for part in links[1:]:
        out = out.unionByName(part)
    return out


def reach_graph(df: DataFrame, key: str, x: str, y: str, min_pts: Sequence[int], reach: float) -> tuple[DataFrame, DataFrame]:
    """Places and links that hold, for each of ``min_pts``, a minimum spanning forest of
    mutual reachability up to ``reach``.

    Places are (p, x, y, n, first, core2_<k> for each k): number, points, least key and
    squared core distances, null beyond ``reach``.  Links are (l, r, d2), l < r.  Points
    whose place is null or not a number are left out.
    """
    most = max(min_pts)
    there = df.select(F.col(key).alias("first"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    there = there.filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    positions = there.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
    positions = pin(sequential_id(positions, ["x", "y"], name="p"))
    sides = _sides(positions, reach, 2 * most)
    near = pin(nearest_positions(positions.select("p", "x", "y", "n"), most, reach, sides))
    places = pin(positions.join(_sorted(near.select("p", *[_core2(k).alias(f"core2_{k}") for k in min_pts])), "p"))
    direct = near.select(F.col("p").alias("l"), F.explode("near").alias("v")).select("l", F.col("v.p").alias("r"), F.col("v.d2").alias("d2"))
    nodes = places.filter(F.col(f"core2_{most}").isNotNull()).select("p", "x", "y", F.col(f"core2_{most}").alias("core2"))
    links = direct.unionByName(_links_by_direction(nodes, sides)).filter("l <> r")
    return places, pin(links.groupBy(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).agg(F.min("d2").alias("d2")))


def weighted_links(places: DataFrame, links: DataFrame, min_pts: int) -> DataFrame:
    """Links (l, r, w2): the squared mutual reachability of both ends."""
    core = F.col(f"core2_{min_pts}")
    ends = places.filter(core.isNotNull())
    left, right = ends.select(F.col("p").alias("l"), core.alias("_cl")), ends.select(F.col("p").alias("r"), core.alias("_cr"))
    return links.join(_sorted(left), "l").join(_sorted(right), "r").select("l", "r", F.greatest("d2", "_cl", "_cr").alias("w2"))


def spanning_forest(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """A minimum spanning forest (l, r, w2) of ``links`` (l, r, w2) over ``nodes`` (node) by
    rounds: every tree takes its least link to another one (of equal ones that with the
    least ends), and trees that meet are one from then on."""
    trees = nodes.select("node", F.col("node").alias("label"))
    parts: list[DataFrame] = []
    while True:
        left, right = trees.select(F.col("node").alias("l"), F.col("label").alias("tl")), trees.select(F.col("node").alias("r"), F.col("label").alias("tr"))
        links = pin(links.select("l", "r", "w2").join(_sorted(left), "l").join(_sorted(right), "r").filter("tl <> tr"))
        if links.isEmpty():
            break
        least = F.min(F.struct("w2", "l", "r", "tl", "tr")).alias("_e")
        own = links.select(F.explode(F.array("tl", "tr")).alias("t"), "w2", "l", "r", "tl", "tr").groupBy("t").agg(least)
        taken = pin(own.select("_e.*").distinct())
        parts.append(taken.select("l", "r", "w2"))
        merged = components(trees.select(F.col("label").alias("node"), "label").distinct(), taken.select(F.col("tl").alias("l"), F.col("tr").alias("r")))
        trees = pin(trees.join(_sorted(merged.select(F.col("node").alias("label"), F.col("label").alias("_to"))), "label").select("node", F.col("_to").alias("label")))
    out = links.select("l", "r", "w2")
    for part in parts:
        out = out.unionByName(part)
    return out


def cut_clusters(places: DataFrame, links: DataFrame, level: Level) -> DataFrame:
    """The cluster number of each place (p, <name>) that belongs to one at this level.

    Dense places in a cell whose diagonal is below the cut hang together anyway, so
    components are those of cells, of which there are as many as the area has.
    """
    core, cut2 = F.col(f"core2_{level.min_pts}"), level.cut * level.cut
    dense = _in_cells(places.filter(core <= cut2), level.cut / 2**0.5 * (1 - 1e-9))
    least = dense.groupBy("cx", "cy").agg(F.min("p").alias("node"))
    dense = pin(dense.join(_sorted(least), ["cx", "cy"]).select("p", "n", "first", "node"))
    ends = dense.select("p", "node")
    low = links.filter(F.col("d2") <= cut2)
    low = low.join(_sorted(ends.toDF("l", "nl")), "l").join(_sorted(ends.toDF("r", "nr")), "r").filter("nl <> nr")
    low = low.select(F.least("nl", "nr").alias("l"), F.greatest("nl", "nr").alias("r")).distinct()
    labels = components(dense.select("node", F.col("node").alias("label")).distinct(), low)
    placed = pin(dense.join(_sorted(labels), "node"))
    sizes = placed.groupBy("label").agg(F.sum("n").alias("_n"), F.min("first").alias("_first")).filter(F.col("_n") >= level.min_size)
    numbered = sequential_id(sizes, ["_first", "label"], name=level.name).select("label", level.name)
    return placed.join(_sorted(numbered), "label").select("p", level.name)


def density_levels(df: DataFrame, key: str, x: str, y: str, levels: Sequence[Level]) -> DataFrame:
    """``df`` with one column per level: cluster numbers 1, 2, ... by the clusters' least
    key, 0 for noise, for clusters below ``min_size`` and for points without a place.

    All levels are cuts of one graph.  A level's clusters are the components of its
    minimum spanning forest below its cut, which are those of the graph.
    """
    places, links = reach_graph(df, key, x, y, sorted({v.min_pts for v in levels}), max(v.cut for v in levels))
    numbers = places.select("p", F.col("x").alias("_x"), F.col("y").alias("_y"))
    for level in levels:
        numbers = numbers.join(_sorted(cut_clusters(places, links, level)), "p", "left")
    match = (F.col(x).cast("double") == F.col("_x")) & (F.col(y).cast("double") == F.col("_y"))
    out = df.join(_sorted(pin(numbers).drop("p")), match, "left").drop("_x", "_y")
    return out.withColumns({v.name: F.coalesce(F.col(v.name), F.lit(0)).cast("bigint") for v in levels})
