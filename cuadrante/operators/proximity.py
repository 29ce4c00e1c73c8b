"""Nearest poles and seeds.

Points are never joined with poles.  Only the occupied grid cells are, each once
however many points it holds: a cell's candidates are all poles that could be
among the k nearest of any place in it, by the triangle inequality on the
sphere.  A point then looks at its own cell's few candidates, row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadrante.functions import geo
from cuadrante.functions.measures import let
from cuadrante.operators.ranking import top_k_per_group
from cuadrante.session import pin

ARRAY_POLES = 20_000  # poles that may travel as one array value (about 1 MB)
CELL_CANDIDATES = 20_000  # candidates one cell may hold before it is refined
SCANNED = 48  # candidates every point of a busy cell may look at
BUSY = 256  # points that make a cell busy
FINER = 3  # levels between a busy cell and the cells it is split into
FINEST_LEVEL = 26
PIN_EVERY = 6  # levels between two cuts of the descent's plan
SLACK_KM = 1e-3  # covers the rounding of acos when pruning


def _radius_km(level: int) -> float:
    """No place in a cell is further than this from the cell's centre."""
    side = 180.0 / 2**level
    return side / 2**0.5 * geo.KM_PER_DEGREE + SLACK_KM


def _centre(index: Column, offset: float, level: int) -> Column:
    side = 180.0 / 2**level
    return (index + F.lit(0.5)) * F.lit(side) - F.lit(offset)


def _around(lon: str) -> Column:
    """Longitude in [-180, 180), however often it goes around."""
    return F.when(F.col(lon).between(-180.0, 179.999999999), F.col(lon)).otherwise(
        F.pmod(F.col(lon) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    )


def _on_earth(lat: str, lon: str) -> Column:
    """Whether there is such a place: both known, and a latitude that exists."""
    return F.coalesce(F.col(lat).between(-90.0, 90.0) & F.col(lon).isNotNull() & ~F.isnan(lon), F.lit(False))


def _indexed(df: DataFrame, lat: str, lon: str, level: int, block_key: str | None) -> DataFrame:
    block = F.lit("") if block_key is None else F.col(block_key).cast("string")
    here = _on_earth(lat, lon)
    return df.withColumns(
        {
            "_r": F.when(here, geo.grid_index(lat, 90.0, level)),
            "_c": F.when(here, geo.grid_index(_around(lon), 180.0, level)),
            "_b": block,
        }
    )


def _distance_to(level: int, lat: Column, lon: Column) -> Column:
    return geo.great_circle_km(
        _centre(F.col("_r"), 90.0, level), _centre(F.col("_c"), 180.0, level), lat, lon
    )


def _unit_vector(lat: Column, lon: Column) -> Column:
    """Place on the unit sphere; two places' distance is the angle of their vectors."""
    a, o = F.radians(lat), F.radians(lon)
    return F.struct(
        (F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z")
    )


def _angle_km(u: Column, v: Column) -> Column:
    cosine = u["x"] * v["x"] + u["y"] * v["y"] + u["z"] * v["z"]
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) * F.lit(geo.EARTH_KM)


def _pruned(found: Column, k: int, reach: float, radius_km: float | None) -> Column:
    """Of poles with their distance ``d`` to a cell's centre, those that may be
    among the k nearest of some place within ``reach`` of it."""

    def bound(found: Column) -> Column:
        kth = F.try_element_at(F.array_sort(F.transform(found, lambda p: p["d"])), F.lit(k))
        limit = F.coalesce(kth + F.lit(2 * reach), F.lit(float("inf")))
        return limit if radius_km is None else F.least(limit, F.lit(radius_km + reach))

    # Bound by name, so that each is computed once a cell and not once a pole.
    return let(
        found,
        lambda f: let(
            F.struct(f.alias("found"), bound(f).alias("bound")),
            lambda w: F.filter(w["found"], lambda p: p["d"] <= w["bound"]),
        ),
    )


def _dealt(cells: DataFrame) -> DataFrame:
    """Few cells would be coalesced into one task, and each has a list to scan."""
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(tasks, "_b", "_r", "_c")


def _from_array(cells: DataFrame, poles: DataFrame, fields: Sequence[str], k: int, level: int,
                radius_km: float | None) -> DataFrame:
    """Candidates of each cell out of one array holding all poles (few of them)."""
    vector = _unit_vector(F.col("lat"), F.col("lon")).alias("u")
    everyone = poles.agg(F.collect_list(F.struct(F.col("_b").alias("b"), vector, *fields)).alias("a")).scalar()
    here = _unit_vector(_centre(F.col("_r"), 90.0, level), _centre(F.col("_c"), 180.0, level))

    def ranked(v: Column) -> Column:
        return F.transform(
            F.filter(v["everyone"], lambda p: p["b"] == F.col("_b")),
            lambda p: F.struct(_angle_km(p["u"], v["here"]).alias("d"), *[p[f].alias(f) for f in fields]),
        )

    near = let(
        F.struct(F.col("_everyone").alias("everyone"), here.alias("here")),
        lambda v: _pruned(ranked(v), k, _radius_km(level), radius_km),
    )
    return _dealt(cells).withColumn("_everyone", everyone).select("_b", "_r", "_c", "_points", near.alias("_near"))


def _from_parents(cells: DataFrame, parents: DataFrame, fields: Sequence[str], k: int, level: int,
                  radius_km: float | None) -> DataFrame:
    """Candidates of each cell out of those of the larger cell that holds it."""
    step = F.lit(2**FINER).cast("bigint")
    inside = cells.withColumns({"_pr": F.floor(F.col("_r") / step), "_pc": F.floor(F.col("_c") / step)})
    above = parents.select("_b", F.col("_r").alias("_pr"), F.col("_c").alias("_pc"), F.col("_near").alias("_above"))
    ranked = F.transform(
        "_above",
        lambda p: F.struct(_distance_to(level, p["lat"], p["lon"]).alias("d"), *[p[f].alias(f) for f in fields]),
    )
    near = _pruned(ranked, k, _radius_km(level), radius_km)
    return _dealt(inside).join(above, ["_b", "_pr", "_pc"]).select("_b", "_r", "_c", "_points", near.alias("_near"))


def _by_descent(cells: DataFrame, poles: DataFrame, fields: Sequence[str], k: int, level: int,
                radius_km: float | None) -> tuple[DataFrame, DataFrame]:
    """Candidates of each cell for any number of poles.

    Both sides are grids that nest.  Starting from the coarsest, every cell
    keeps the pole cells that may hold one of its k nearest poles, and replaces
    them by their occupied quarters on the next level.  Each step is an equi-join
    of cells with pole *counts*; poles themselves join once, at the end.
    """
    fine = pin(poles.groupBy("_b", "_r", "_c").agg(F.count(F.lit(1)).alias("_n")))
    own = _radius_km(level)
    frontier = cells.select("_b", "_r", "_c").withColumn(
        "_p", F.explode(F.array(*[F.struct(F.lit(r).cast("bigint").alias("r"), F.lit(c).cast("bigint").alias("c"))
                                  for r in (0, 1) for c in (0, 1, 2)]))
    ).select("_b", "_r", "_c", F.col("_p.r").alias("_pr"), F.col("_p.c").alias("_pc"))
    cell = Window.partitionBy("_b", "_r", "_c")
    for at in range(0, level + 1):
        step = F.lit(2 ** (level - at)).cast("bigint")
        counts = fine.groupBy(
            "_b", F.floor(F.col("_r") / step).alias("_pr"), F.floor(F.col("_c") / step).alias("_pc")
        ).agg(F.sum("_n").alias("_n"))
        met = frontier.join(counts, ["_b", "_pr", "_pc"])
        spread = F.lit(own + _radius_km(at))
        apart = _distance_to(level, _centre(F.col("_pr"), 90.0, at), _centre(F.col("_pc"), 180.0, at))
        met = met.withColumn("_d", apart)
        reached = F.sum("_n").over(cell.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
        met = met.withColumn("_reached", reached)
        bound = F.coalesce(
            F.min(F.when(F.col("_reached") >= k, F.col("_d") + spread)).over(cell), F.lit(float("inf"))
        )
        if radius_km is not None:
            bound = F.least(bound, F.lit(radius_km))
        kept = met.withColumn("_bound", bound).filter(F.col("_d") - spread <= F.col("_bound"))
        if at % PIN_EVERY == PIN_EVERY - 1 or at == level:
            kept = pin(kept.select("_b", "_r", "_c", "_pr", "_pc", "_n"))
        if at < level:
            quarters = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
            frontier = kept.withColumn("_q", F.explode(quarters)).select(
                "_b", "_r", "_c",
                (F.col("_pr") * 2 + F.col("_q.i")).alias("_pr"),
                (F.col("_pc") * 2 + F.col("_q.j")).alias("_pc"),
            )
    sized = kept.withColumn("_total", F.sum("_n").over(cell))
    dense = sized.filter(F.col("_total") > CELL_CANDIDATES).select("_b", "_r", "_c").distinct()
    if level >= FINEST_LEVEL:
        dense, few = dense.limit(0), sized
    else:
        few = sized.filter(F.col("_total") <= CELL_CANDIDATES)
    named = poles.select(F.col("_b"), F.col("_r").alias("_pr"), F.col("_c").alias("_pc"), *fields)
    near = (
        few.join(named, ["_b", "_pr", "_pc"])
        .groupBy("_b", "_r", "_c")
        .agg(F.collect_list(F.struct(F.lit(0.0).alias("d"), *fields)).alias("_near"))
    ).join(cells, ["_b", "_r", "_c"])
    return near, dense


def nearest_k(
    points: DataFrame,
    poles: DataFrame,
    k: int,
    lat: str = "lat",
    lon: str = "lon",
    pole_id: str = "pole_id",
    pole_lat: str = "pole_lat",
    pole_lon: str = "pole_lon",
    carry: Sequence[str] = (),
    name: str = "nearest",
    level: int = 8,
    block_key: str | None = None,
    radius_km: float | None = None,
    array_poles: int = ARRAY_POLES,
) -> DataFrame:
    """The k nearest poles of every point as an array of (d, id, carried columns).

    Sorted by distance (to the millimetre), then id.  ``radius_km`` leaves out
    poles further away; ``block_key`` (a column of both sides) restricts a point
    to poles of its own block.  Longitudes may go around the globe.  Points without a
    place (a coordinate is null, or the latitude is beyond 90 degrees) get an empty
    array, and poles without one are nobody's nearest.

    The number of poles is measured: few travel as one array value, more are
    found by descending both grids.  ``level`` sets the cell size; cells that
    would hold too many candidates are refined until they do not.
    """
    fields = ["id", "lat", "lon", *carry]
    named = poles.filter(_on_earth(pole_lat, pole_lon)).select(
        F.col(pole_id).alias("id"),
        F.col(pole_lat).cast("double").alias("lat"),
        _around(pole_lon).cast("double").alias("lon"),
        *carry,
        *([F.col(block_key).alias("_block")] if block_key else []),
    )
    block = "_block" if block_key else None
    # Of poles in the same place only the k with the lowest ids can be chosen.
    same_place = ["lat", "lon", *([block] if block else [])]
    named = top_k_per_group(named, same_place, "id", k, "_rn").drop("_rn")
    few = named.limit(array_poles + 1).count() <= array_poles
    return _nearest(points, named, fields, k, lat, lon, carry, name, level, block_key, block, radius_km, few)


def _nearest(points, named, fields, k, lat, lon, carry, name, level, block_key, block, radius_km, few) -> DataFrame:
    keys = ["_b", "_r", "_c"]

    def occupied(placed: DataFrame) -> DataFrame:
        here = placed.filter(F.col("_r").isNotNull() & F.col("_c").isNotNull())
        return here.groupBy(*keys).agg(F.count(F.lit(1)).alias("_points"))

    def measured(p: Column) -> Column:
        d = geo.great_circle_km(lat, lon, p["lat"], p["lon"])
        return F.struct(F.round(d, 6).alias("d"), *[p[f].alias(f) for f in ("id", *carry)])

    def finish(placed: DataFrame, near: DataFrame) -> DataFrame:
        ranked = F.transform("_near", measured)
        if radius_km is not None:
            ranked = F.filter(ranked, lambda p: p["d"] <= F.lit(float(radius_km)))
        # Distances are never null here: an unknown one would sort first and win.
        best = F.slice(F.array_sort(ranked), 1, k)
        found = placed.join(near.select(*keys, "_near"), keys, "left")
        return found.withColumn(name, F.coalesce(best, F.array())).select(*points.columns, name)

    placed = _indexed(points, lat, lon, level, block_key)
    poles = _indexed(named, "lat", "lon", level, block)
    parts = []
    if few:
        near = pin(_from_array(occupied(placed), poles, fields, k, level, radius_km))
    else:
        near, dense = _by_descent(pin(occupied(placed)), poles, fields, k, level, radius_km)
        near = pin(near)
        if not dense.isEmpty():
            crowded = placed.join(dense, keys, "left_semi").select(*points.columns)
            parts.append(
                _nearest(crowded, named, fields, k, lat, lon, carry, name,
                         min(level + 4, FINEST_LEVEL), block_key, block, radius_km, False)
            )
            placed = placed.join(dense, keys, "left_anti")
    # Busy cells with long lists are split into finer cells, whose lists come out
    # of theirs, so that many points in one place do not each scan a long list.
    busy = (F.size("_near") > F.lit(max(SCANNED, 4 * k))) & (F.col("_points") > F.lit(BUSY))
    while level + FINER <= FINEST_LEVEL:
        parents = near.filter(busy)
        if parents.isEmpty():
            break
        split = parents.select(*keys)
        parts.append(finish(placed.join(split, keys, "left_anti"), near))
        level += FINER
        placed = _indexed(placed.join(split, keys, "left_semi").select(*points.columns), lat, lon, level, block_key)
        near = pin(_from_parents(occupied(placed), parents, fields, k, level, radius_km))
    out = finish(placed, near)
    for part in parts:
        out = out.unionByName(part)
    return out


def assign_nearest(
    points: DataFrame,
    seeds: DataFrame,
    radius_km: float,
    lat: str = "lat",
    lon: str = "lon",
    seed_id: str = "seed_id",
    seed_lat: str = "seed_lat",
    seed_lon: str = "seed_lon",
    block_key: str | None = None,
    **options,
) -> DataFrame:
    """Attach the nearest seed within the radius (the one whose clipped Voronoi
    cell holds the point); null when there is none.  Ties go to the lower id."""
    found = nearest_k(points, seeds, 1, lat, lon, seed_id, seed_lat, seed_lon, name="_seed",
                      block_key=block_key, radius_km=radius_km, **options)
    first = F.try_element_at("_seed", F.lit(1))
    return found.withColumns({"seed_id": first["id"], "seed_km": first["d"]}).drop("_seed")


def uplift_of(nearest: str | Column = "nearest", weight: str = "w", friction: str = "f") -> Column:
    """Sum over the poles of weight / (1 + distance)^friction; 0 without poles."""
    terms = F.transform(nearest, lambda p: p[weight] / F.pow(F.lit(1.0) + p["d"], p[friction]))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.coalesce(total, F.lit(0.0))


def gravity_uplift(points: DataFrame, poles: DataFrame, k: int, money: Sequence[str],
                   name: str = "uplift", **options) -> DataFrame:
    """Raise money columns by the pull of the k nearest poles, to the cent.

    Poles carry a weight ``w`` and a friction exponent ``f``.
    """
    found = nearest_k(points, poles, k, carry=["w", "f"], name="_poles", **options)
    pulled = found.withColumn(name, uplift_of("_poles")).drop("_poles")
    return pulled.withColumns(
        {c: F.round(F.col(c) * (F.lit(1.0) + F.col(name)), 2) for c in money}
    )
