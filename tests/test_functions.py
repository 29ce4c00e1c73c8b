import datetime
import math

import pytest
from pyspark.sql import functions as F

from cuadrante.functions import draws, finance, geo, keys, measures


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return row.select(column.alias("v")).first()[0]


def test_instalment_zero_rate(spark):
    assert one(spark, finance.instalment(F.lit(1200.0), F.lit(0.0), F.lit(12))) == 100.0


def test_instalment(spark):
    got = one(spark, finance.instalment(F.lit(1000.0), F.lit(0.01), F.lit(10)))
    assert got == pytest.approx(1000 * 0.01 / (1 - 1.01**-10))


@pytest.mark.parametrize(
    "balance,payment,rate,months",
    [(0.0, 10.0, 0.01, 0), (-5.0, 10.0, 0.01, 0), (1000.0, 10.0, 0.01, 99), (1000.0, 5.0, 0.01, 99),
     (1000.0, 110.0, 0.01, 10), (100000.0, 1000.5, 0.01, 99), (1000.0, 100.0, 0.0, 99)],
)
def test_months_to_settle(spark, balance, payment, rate, months):
    assert one(spark, finance.months_to_settle(F.lit(balance), F.lit(payment), F.lit(rate))) == months


def test_debt_to_income_of_no_income_is_null(spark):
    assert one(spark, finance.debt_to_income(F.lit(10.0), F.lit(0.0))) is None


def test_same_place_is_at_distance_zero(spark):
    km = one(spark, geo.great_circle_km(F.lit(19.4), F.lit(-99.1), F.lit(19.4), F.lit(-99.1)))
    assert km is not None and not math.isnan(km) and km < 1e-3


def test_distance_beyond_the_threshold_is_null(spark):
    assert one(spark, geo.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(10.0), max_km=100)) is None


def test_cells_nest(spark):
    df = spark.range(500).select((F.rand(1) * 180 - 90).alias("lat"), (F.rand(2) * 360 - 180).alias("lon"))
    both = df.select(geo.grid_parent(geo.grid_cell("lat", "lon", 9), 3).alias("a"), geo.grid_cell("lat", "lon", 6).alias("b"))
    assert both.filter("a <> b").count() == 0


def test_hash_fraction_is_uniform_and_unsigned(spark):
    df = spark.range(20000)
    for algo in ("md5", "murmur3"):
        low, high, mean = df.select(draws.hash_fraction("id", algo=algo).alias("u")).agg(
            F.min("u"), F.max("u"), F.avg("u")
        ).first()
        assert 0 <= low < 0.01 and 0.98 < high < 1 and abs(mean - 0.5) < 0.02


def test_signed_fraction_reproduces_the_remainder(spark):
    df = spark.range(1000).select(
        draws.hash_fraction("id", algo="murmur3", signed=True).alias("u"), (F.hash("id") % 100 / 100).alias("v")
    )
    assert df.filter(F.abs(F.col("u") - F.col("v")) > 1e-12).count() == 0
    assert df.filter("u < 0").count() > 0


def test_weighted_pick_follows_the_weights(spark):
    u = draws.hash_fraction("id")
    got = {r["v"]: r["n"] for r in spark.range(20000).groupBy(draws.weighted_pick(u, ["a", "b", "c"], [1, 2, 7]).alias("v"))
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    for v, w in (("a", 0.1), ("b", 0.2), ("c", 0.7)):
        assert abs(got[v] / 20000 - w) < 0.02
    assert one(spark, draws.weighted_pick(F.lit(None).cast("double"), ["a", "b"], [1, 1])) is None


def test_padding_keeps_long_values_whole(spark):
    assert one(spark, keys.padded(F.lit("123456789"), 7)) == "123456789"
    assert one(spark, keys.padded(F.lit(42), 7)) == "0000042"


def test_birth_date_gives_the_age(spark):
    born = one(spark, keys.birth_date(F.lit(30), F.lit("2024-06-01").cast("date"), F.lit(0.999)))
    assert datetime.date(1993, 6, 2) <= born <= datetime.date(1994, 6, 1)


def test_prefixed_code_of_unknown_entity(spark):
    assert one(spark, keys.prefixed_code(F.lit(99), F.lit(0.5))) == "05000"
    assert one(spark, keys.prefixed_code(F.lit(1), F.lit(0.0))) == "20000"


def test_floor_keeps_null(spark):
    assert one(spark, measures.floor_at(F.lit(None).cast("double"), 0.05)) is None
    assert one(spark, measures.floor_at(F.lit(0.01), 0.05)) == 0.05


def test_weighted_mean_without_weight_is_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "v double, w double")
    assert df.agg(measures.weighted_mean("v", "w").alias("m")).first()[0] is None


def test_normal_noise(spark):
    u1, u2 = draws.hash_fraction("id", salt="1"), draws.hash_fraction("id", salt="2")
    mean, dev = spark.range(20000).select(draws.normal(u1, u2, 5.0, 2.0).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean - 5) < 0.1 and abs(dev - 2) < 0.1
