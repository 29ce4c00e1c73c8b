import math
import random

import pytest
from pyspark.sql import functions as F

from cuadrante.operators import proximity


def km(a, b):
    (la, lo), (pa, po) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    c = math.sin(la) * math.sin(pa) + math.cos(la) * math.cos(pa) * math.cos(po - lo)
    return math.acos(max(-1.0, min(1.0, c))) * 6371.0


def brute(points, poles, k, radius=None, block=False):
    out = {}
    for p in points:
        ds = sorted(
            (round(km(p[1:3], q[1:3]), 6), q[0]) for q in poles if p[1] is not None and (not block or p[3] == q[3])
        )
        out[p[0]] = [i for d, i in ds if radius is None or d <= radius][:k]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)

    def place(hot):
        if rng.random() < hot:
            return 19.4 + rng.gauss(0, 0.01), -99.1 + rng.gauss(0, 0.01)
        return rng.uniform(-85, 85), rng.uniform(-180, 180)

    points = [(i, *place(0.5), i % 2) for i in range(300)] + [(900, None, None, 0), (901, 89.99, 179.99, 1), (902, -90.0, -180.0, 0)]
    poles = [(i, *place(0.4), i % 2) for i in range(400)]
    poles += [(1000 + i, 19.4, -99.1, i % 2) for i in range(30)]  # copies of one place
    p = spark.createDataFrame(points, "id long, lat double, lon double, b int")
    q = spark.createDataFrame(poles, "pole_id long, pole_lat double, pole_lon double, b int")
    return points, poles, p, q


def found(df):
    return {r["id"]: [x["id"] for x in r["nearest"]] for r in df.collect()}


@pytest.mark.parametrize("array_poles", [10**6, 0])
def test_nearest_matches_brute_force(data, array_poles):
    points, poles, p, q = data
    got = found(proximity.nearest_k(p, q, 3, level=6, array_poles=array_poles))
    assert got == brute(points, poles, 3)


@pytest.mark.parametrize("array_poles", [10**6, 0])
def test_nearest_within_radius_and_block(data, array_poles):
    points, poles, p, q = data
    got = found(proximity.nearest_k(p, q, 4, level=6, array_poles=array_poles, radius_km=400.0, block_key="b"))
    assert got == brute(points, poles, 4, 400.0, True)


def test_crowded_cells_are_refined(data, monkeypatch):
    points, poles, p, q = data
    monkeypatch.setattr(proximity, "CELL_CANDIDATES", 60)
    got = found(proximity.nearest_k(p, q, 3, level=4, array_poles=0))
    assert got == brute(points, poles, 3)


def test_fewer_poles_than_k(data):
    points, poles, p, q = data
    for array_poles in (100, 0):
        got = found(proximity.nearest_k(p, q.filter("pole_id < 2"), 3, level=5, array_poles=array_poles))
        assert got == brute(points, poles[:2], 3)


def test_no_poles_and_no_points(data):
    _, _, p, q = data
    for array_poles in (100, -1):
        assert set(map(tuple, found(proximity.nearest_k(p, q.limit(0), 3, array_poles=array_poles)).values())) == {()}
    assert proximity.nearest_k(p.limit(0), q, 3).count() == 0


def test_equal_distances_go_to_the_lower_id(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double")
    q = spark.createDataFrame([(7, 0.0, 1.0), (5, 0.0, -1.0)], "pole_id long, pole_lat double, pole_lon double")
    assert found(proximity.nearest_k(p, q, 1)) == {1: [5]}


def test_assign_beyond_the_radius_is_null(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 5.0)], "id long, lat double, lon double")
    q = spark.createDataFrame([(7, 0.0, 0.01)], "seed_id long, seed_lat double, seed_lon double")
    got = {r["id"]: r["seed_id"] for r in proximity.assign_nearest(p, q, 3.0).collect()}
    assert got == {1: 7, 2: None}


def test_uplift_is_zero_without_poles(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0, 100.0)], "id long, lat double, lon double, m double")
    q = spark.createDataFrame([], "pole_id long, pole_lat double, pole_lon double, w double, f double")
    row = proximity.gravity_uplift(p, q, 3, ["m"]).first()
    assert row["uplift"] == 0.0 and row["m"] == 100.0


@pytest.mark.parametrize("array_poles", [10**6, 0])
def test_busy_cells_are_split(data, monkeypatch, array_poles):
    points, poles, p, q = data
    monkeypatch.setattr(proximity, "SCANNED", 12)
    monkeypatch.setattr(proximity, "BUSY", 3)
    got = found(proximity.nearest_k(p, q, 3, level=5, array_poles=array_poles))
    assert got == brute(points, poles, 3)


@pytest.mark.parametrize("array_poles", [0, 20_000])
def test_the_globe_is_round(spark, array_poles):
    """Both ways to find candidates agree on longitudes past 180 and odd places."""
    points = spark.createDataFrame([(1, 0.0, -179.0), (2, 0.0, 541.0), (3, None, 5.0), (4, 91.0, 5.0), (5, 90.0, 180.0)], "id int, lat double, lon double")
    poles = spark.createDataFrame([(1, 0.0, -190.0), (2, 0.0, 0.0), (3, -95.0, -179.0), (4, None, -179.0), (5, 0.0, 181.5)], "pole_id int, pole_lat double, pole_lon double")
    got = {r["id"]: [p["id"] for p in r["nearest"]] for r in proximity.nearest_k(points, poles, 2, array_poles=array_poles).collect()}
    assert got[1] == got[2] == [5, 1] and got[3] == got[4] == [] and len(got[5]) == 2
