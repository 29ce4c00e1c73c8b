"""Density levels against brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from cuadrante.operators import density
from cuadrante.operators.density import Level
from cuadrante.plans import domain
from conftest import SF_SMALL


def frame(spark, points):
    return spark.createDataFrame(points, "id long, x double, y double")


def core2(points, k):
    out = []
    for p in points:
        d = sorted((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2 for q in points)
        out.append(d[k - 1] if len(d) >= k else None)
    return out


def joined(n, edges):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    used = []
    for w, i, j in sorted(edges):
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            used.append(w)
    return [find(i) for i in range(n)], used


def pairs(points, core, cut2):
    for i, p in enumerate(points):
        for j in range(i):
            q = points[j]
            w = max((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2, core[i] or cut2 + 1, core[j] or cut2 + 1) if core[i] is not None and core[j] is not None else None
            if w is not None and w <= cut2:
                yield w, i, j


def brute(points, level):
    core, cut2 = core2(points, level.min_pts), level.cut * level.cut
    core = [c if c is None or c > 0 else 1e-300 for c in core]
    root, _ = joined(len(points), pairs(points, core, cut2))
    groups = {}
    for i, p in enumerate(points):
        if core[i] is not None and core[i] <= cut2:
            groups.setdefault(root[i], []).append(p[0])
    kept = sorted(min(g) for g in groups.values() if len(g) >= level.min_size)
    out = {p[0]: 0 for p in points}
    for g in groups.values():
        if len(g) >= level.min_size:
            out |= {k: 1 + kept.index(min(g)) for k in g}
    return out


def mixed():
    rng = random.Random(11)
    out = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(260)]
    out += [(1000 + i, rng.gauss(2, 0.02), rng.gauss(2, 0.02)) for i in range(120)]  # a dense place
    out += [(2000 + i, rng.gauss(2.6, 0.03), rng.gauss(2, 0.2)) for i in range(80)]  # a rim that faces it
    out += [(3000 + i, -3.0, -3.0) for i in range(30)]  # copies of one place
    out += [(4000 + i, -5 + 0.01 * i, -5.0) for i in range(100)]  # a straight line
    out += [(5000 + i, float(i % 7), float(i // 7)) for i in range(49)]  # a grid with many ties
    return out


LEVELS = [Level("micro", 15, 5, 0.45), Level("macro", 60, 20, 1.1)]


def test_levels_match_brute_force(spark):
    points = mixed()
    got = density.density_levels(frame(spark, points), "id", "x", "y", LEVELS).collect()
    for level in LEVELS:
        assert {r["id"]: r[level.name] for r in got} == brute(points, level), level
    assert all(max(r[v.name] for r in got) > 0 for v in LEVELS)


def test_core_distances_and_forest(spark):
    points, reach = mixed(), 1.1
    places, links = density.reach_graph(frame(spark, points), "id", "x", "y", [5, 20], reach)
    at = {(r["x"], r["y"]): r for r in places.collect()}
    assert links.count() <= (20 + 8) * len(at)
    for k in (5, 20):
        core = core2(points, k)
        for p, c in zip(points, core):
            assert at[p[1], p[2]][f"core2_{k}"] == (c if c is not None and c <= reach * reach else None)
        nodes = places.filter(F.col(f"core2_{k}").isNotNull()).select(F.col("p").alias("node"))
        forest = density.spanning_forest(nodes, density.weighted_links(places, links, k).filter(F.col("w2") <= reach * reach))
        got = sorted(r["w2"] for r in forest.collect())
        alone = sorted({(p[1], p[2]): c for p, c in zip(points, core)}.items())
        single = [(0, *xy) for xy, _ in alone]
        _, used = joined(len(single), pairs(single, [c if c is None or c > 0 else 1e-300 for _, c in alone], reach * reach))
        assert got == sorted(0.0 if w == 1e-300 else w for w in used)


@pytest.mark.parametrize("points", [[], [(1, None, 2.0), (2, float("nan"), 0.0)], [(1, 0.0, 0.0)], [(i, 1.0, 1.0) for i in range(5)]])
def test_few_places(spark, points):
    got = density.density_levels(frame(spark, points), "id", "x", "y", [Level("c", 5, 5, 1.0)]).collect()
    assert {r["id"]: r["c"] for r in got} == {p[0]: int(len(points) == 5) for p in points}


def test_points_exactly_at_the_cut_count(spark):
    points = [(i, float(i), 0.0) for i in range(5)]
    for cut, label in ((1.0, 1), (0.99, 0)):
        got = density.density_levels(frame(spark, points), "id", "x", "y", [Level("c", 1, 2, cut)]).collect()
        assert {r["c"] for r in got} == {label}


# What may be sent to all tasks has a row for each range of a numbering or each cell of a level.
SMALL = ("[_part#", "[label#")


def sent(plans):
    assert sum("SortMergeJoin" in p for p in plans) > 2
    return [line for p in plans for line in p.splitlines() if "Broadcast" in line and "Join" in line and not any(s in line for s in SMALL)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pinned_plans(monkeypatch):
    plans, keep = [], density.pin
    monkeypatch.setattr(density, "pin", lambda df: plans.append(plan(df)) or keep(df))
    return plans


def test_places_are_not_broadcast(spark, monkeypatch):
    """Their files are below Spark's threshold long before their rows fit the driver."""
    plans = pinned_plans(monkeypatch)
    plans.append(plan(domain.core_distances(spark, SF_SMALL)))
    assert not sent(plans)


def test_levels_do_not_broadcast_places(spark, monkeypatch):
    places, links = density.reach_graph(frame(spark, mixed()), "id", "x", "y", [5, 20], 1.1)
    monkeypatch.setattr(density, "reach_graph", lambda *a: (places, links))
    plans = pinned_plans(monkeypatch)
    plans.append(plan(density.density_levels(frame(spark, mixed()), "id", "x", "y", LEVELS)))
    plans.append(plan(density.weighted_links(places, links, 5)))
    assert not sent(plans)
