import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cuadrante.operators import network, scoring


def auc(df, score):
    rows = df.filter(F.col(score).isNotNull()).select(F.col(score).alias("rawPrediction"), F.col("label"))
    return BinaryClassificationEvaluator(numBins=0).evaluate(rows)


@pytest.fixture(scope="module")
def ring(spark):
    """Label 1 inside a ring, which no linear model tells apart."""
    x, y = F.rand(1) * 2 - 1, F.rand(2) * 4 + 10
    df = spark.range(6000).select("id", x.alias("x"), y.alias("y"), F.lit(3.0).alias("same"))
    inside = F.col("x") ** 2 + ((F.col("y") - 12) / 2) ** 2 < 0.5
    return df.withColumn("label", inside.cast("double")).withColumn("x", F.when(F.col("id") % 50 != 0, F.col("x")))


def test_gradient_is_the_slope():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(7, 3)), (draw.random(7) < 0.5).astype(float)
    shapes = [(4, 5), (6, 2), (3, 1)]
    flat = draw.normal(size=sum(a * b for a, b in shapes))
    keep = (draw.random((7, 5)) >= 0.2) / 0.8

    def loss(w):
        p = network._forward(x, network._cut(w, shapes), keep)[-1][:, 0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    got = network._gradient(x, y, network._cut(flat, shapes), keep)
    for i in range(len(flat)):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("shards", [1, 3])
def test_learns_as_well_as_the_other_network(ring, shards):
    train, held_out = scoring.hash_split(ring, ["id"])
    net = network.train_network(train, ["x", "y", "same"], "label", ["id"], shards=shards, epochs=20)
    scored = held_out.withColumn("p", network.network_probability(net))
    assert scored.filter("(x IS NULL) <> (p IS NULL) OR p < 0 OR p > 1").count() == 0
    other = scoring.train_models(ring, {"m": scoring.ModelConfig("label", ["x", "y"], "mlp", params={"maxIter": 20})}, ["id"])["m"]
    assert auc(scored, "p") >= max(0.95, other.metrics.first()["auc"] - 0.01)


def test_same_network_whatever_the_partitions(ring):
    nets = [network.train_network(df, ["x", "y"], "label", ["id"], shards=2, epochs=2) for df in (ring, ring.repartition(7, "x"))]
    for a, b in zip(nets[0].layers, nets[1].layers):
        assert np.allclose(a, b, atol=1e-9)


def test_no_rows_and_repeated_rows(spark, ring):
    with pytest.raises(ValueError):
        network.train_network(ring.filter("x IS NULL"), ["x"], "label", ["id"])
    same = spark.range(300).select(F.lit(1).alias("id"), F.lit(0.5).alias("x"), (F.col("id") % 2).alias("label"))
    net = network.train_network(same, ["x"], "label", ["id"], epochs=2)
    assert 0.3 < same.select(network.network_probability(net).alias("p")).first()["p"] < 0.7
