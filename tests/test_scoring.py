import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cuadrante.functions import draws
from cuadrante.operators import scoring


@pytest.fixture(scope="module")
def frame(spark):
    u = [draws.hash_fraction("id", salt=s) for s in "abc"]
    return spark.range(600).select(
        "id", F.when(F.col("id") % 20 != 0, u[0]).alias("x"), u[1].alias("y"),
        (u[0] + u[1] > 1).cast("double").alias("label"),
        F.when(u[0] < 0.3, "low").when(u[0] < 0.7, "mid").otherwise("high").alias("status"),
    ).cache()


@pytest.mark.parametrize("kind,params", [
    ("logistic", {}), ("gbt", {"maxIter": 3}), ("xgboost", {"maxIter": 3}), ("random_forest", {"numTrees": 5}),
    ("mlp", {"maxIter": 60}),
])
def test_each_model_learns(frame, kind, params):
    config = scoring.ModelConfig("label", ["x", "y"], kind, params=params)
    got = scoring.train_models(frame, {"m": config}, ["id"])["m"]
    row = got.metrics.first()
    assert got.quarantined.count() == 30 and row["n_rows"] < 300
    assert row["weighted_f1"] > 0.7 and row["auc"] > 0.8
    again = MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(got.predictions)
    assert row["weighted_f1"] == pytest.approx(again)


def test_multiclass_text_label(frame):
    config = scoring.ModelConfig("status", ["x", "y"], "random_forest", True, {"numTrees": 5})
    row = scoring.train_models(frame, {"m": config}, ["id"])["m"].metrics.first()
    assert row["auc"] is None and row["weighted_recall"] > 0.8


def test_unknown_model(frame):
    with pytest.raises(ValueError):
        scoring.train_models(frame, {"m": scoring.ModelConfig("label", ["x"], "svm")}, ["id"])


def test_features_can_refuse_nulls(frame):
    assert scoring.features(frame, ["x", "y"]).count() == 570
    with pytest.raises(Exception):
        scoring.features(frame, ["x", "y"], "error").select("features").collect()


def test_segments(frame):
    found = scoring.segment(frame, ["x", "y"], k=3)
    assert found.count() == frame.count() and found.filter("segment IS NOT NULL").select("segment").distinct().count() == 3
    assert found.filter("(x IS NULL OR y IS NULL) <> (segment IS NULL)").count() == 0


def test_split_is_the_same_every_time(frame):
    a, b = (scoring.hash_split(frame, ["id"])[0] for _ in range(2))
    assert sorted(r[0] for r in a.select("id").collect()) == sorted(r[0] for r in b.select("id").collect())
    assert 0.6 < a.count() / 600 < 0.8


def test_missing_score_is_routed(spark):
    base = spark.createDataFrame([(1,), (1,), (2,)], "c int")
    p = spark.createDataFrame([(1, 0.5), (2, 0.5)], "c int, p_credit double")
    q = spark.createDataFrame([(1, 1.0)], "c int, p_liquidity double")
    got = {r["c"]: (r["score"], r["routing"]) for r in scoring.blend_scores(base, "c", {"p_credit": p, "p_liquidity": q}).collect()}
    assert got == {1: (pytest.approx(0.7), scoring.COMPLETE), 2: (None, scoring.INCOMPLETE)}


def test_labels_by_frequency(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), ("",)], "t string").withColumn("other", F.lit(1))
    got = scoring.string_index(df, "t")
    assert sorted((r["t"], r["t_index"]) for r in got.collect()) == [("", 1.0), ("a", 2.0), ("b", 3.0), ("c", 0.0), ("c", 0.0)]
    known = scoring.label_table(df.filter("t <> 'c'"), "t", "i")
    assert sorted((r["t"], r["x"]) for r in scoring.string_index(df, "t", "x", known).collect()) == [("", 0.0), ("a", 1.0), ("b", 2.0)]
    assert scoring.string_index(df.limit(0), "t").count() == 0


def test_text_target_keeps_its_labels(frame):
    config = scoring.ModelConfig("status", ["x", "y"], "random_forest", True, {"numTrees": 3})
    got = scoring.train_models(frame, {"m": config}, ["id"])["m"]
    counts = {r["status"]: r["status_indexed"] for r in got.labels.collect()}
    assert sorted(counts.values()) == [0.0, 1.0, 2.0]
    assert {r["label"] for r in got.confusion.collect()} <= set(counts.values())
