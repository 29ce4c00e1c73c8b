import random

import pytest

from cuadrante.operators import clusters


def brute(points, eps, min_pts, min_size=1):
    n = len(points)
    near = [
        [j for j in range(n) if (points[i][1] - points[j][1]) ** 2 + (points[i][2] - points[j][2]) ** 2 <= eps * eps]
        for i in range(n)
    ]
    core = {i for i in range(n) if len(near[i]) >= min_pts}
    label = {}
    for i in sorted(core, key=lambda i: points[i][0]):
        if i in label:
            continue
        stack, label[i] = [i], points[i][0]
        while stack:
            for j in near[stack.pop()]:
                if j in core and j not in label:
                    label[j] = label[i]
                    stack.append(j)
    for i in range(n):
        if i not in core:
            around = [label[j] for j in near[i] if j in core]
            if around:
                label[i] = min(around)
    size = {}
    for v in label.values():
        size[v] = size.get(v, 0) + 1
    ids = {v: k for k, v in enumerate(sorted(v for v, s in size.items() if s >= min_size), 1)}
    return {points[i][0]: ids.get(label.get(i), 0) for i in range(n)}


def frame(spark, points):
    return spark.createDataFrame(points, "id long, x double, y double")


def found(df):
    return {r["id"]: r["cluster"] for r in df.collect()}


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    out = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(250)]
    out += [(1000 + i, rng.gauss(1, 0.05), rng.gauss(1, 0.05)) for i in range(150)]  # a hot cell
    out += [(2000 + i, -3.0, -3.0) for i in range(40)]  # copies of one place
    return out


@pytest.mark.parametrize("few", [4])
@pytest.mark.parametrize("eps,min_pts,min_size", [(0.35, 4, 6)])
def test_matches_brute_force(spark, points, few, eps, min_pts, min_size):
    got = found(clusters.density_clusters(frame(spark, points), "id", "x", "y", eps, min_pts, min_size, few=few))
    assert got == brute(points, eps, min_pts, min_size)


def test_points_exactly_at_the_radius_count(spark):
    pts = [(i, float(i), 0.0) for i in range(5)]
    assert found(clusters.density_clusters(frame(spark, pts), "id", "x", "y", 1.0, 2)) == {i: 1 for i in range(5)}
    assert set(found(clusters.density_clusters(frame(spark, pts), "id", "x", "y", 0.99, 2)).values()) == {0}


def test_noise_null_and_empty(spark):
    pts = [(1, 0.0, 0.0), (2, None, 1.0)]
    assert found(clusters.density_clusters(frame(spark, pts), "id", "x", "y", 1.0, 2)) == {1: 0, 2: 0}
    assert clusters.density_clusters(frame(spark, []), "id", "x", "y", 1.0, 2).count() == 0


def test_components_of_a_long_chain(spark):
    n = 100
    nodes = spark.range(n).selectExpr("id AS node", "(id * 7919) % 100 AS label")
    edges = spark.range(n - 1).selectExpr("id AS l", "id + 1 AS r").filter("l <> 49")
    got = {r["node"]: r["label"] for r in clusters.components(nodes, edges).collect()}
    low = min((i * 7919) % 100 for i in range(50))
    high = min((i * 7919) % 100 for i in range(50, 100))
    assert {got[i] for i in range(50)} == {low} and {got[i] for i in range(50, 100)} == {high}


def test_summary_skips_noise(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (4,)], "cluster int")
    assert tuple(clusters.cluster_summary(df).first()) == (2, 3, 1)
