"""Segments, credit models, their evaluation and the blended score, on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cuadrante.functions import draws
from cuadrante.operators import ranking
from cuadrante.operators.relational import quarantine
from cuadrante.session import pin

SEED = 42
TRAIN_SHARE = 0.7
# Hidden layers of the network, rounds of boosting, iterations of
# the logistic model, weights of the blended score and its two routing labels.
HIDDEN_LAYERS = [16, 8]
BOOSTING_ROUNDS = 30
LOGISTIC_ITERATIONS = 10
BLEND_WEIGHTS = {"p_credit": 0.6, "p_liquidity": 0.4}
COMPLETE = "Score Integral Completo"
INCOMPLETE = "Datos Insuficientes - Requiere Modelo Reducido"


@dataclass(frozen=True)
class ModelConfig:
    """One model to train: what to predict, from which columns, and how."""

    target: str
    features: Sequence[str]
    type: str = "gbt"
    multiclass: bool = False
    params: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with its held-out predictions and their evaluation.  ``labels`` is
    the index of a text target's labels, else None."""

    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    quarantined: DataFrame
    confusion: DataFrame
    labels: DataFrame | None = None


def features(df: DataFrame, cols: Sequence[str], handle_invalid: str = "skip", name: str = "features") -> DataFrame:
    """Columns as one vector.  ``skip`` drops rows with nulls, ``error`` raises."""
    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid=handle_invalid).transform(df)


def scaled_stages(cols: Sequence[str], handle_invalid: str = "skip") -> list:
    """Assembler and scaler to zero mean and unit deviation."""
    return [
        VectorAssembler(inputCols=list(cols), outputCol="features_raw", handleInvalid=handle_invalid),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def scaled_features(df: DataFrame, cols: Sequence[str], handle_invalid: str = "skip") -> DataFrame:
    """Standardised columns as ``features``; the scaler is fitted once."""
    return Pipeline(stages=scaled_stages(cols, handle_invalid)).fit(df).transform(df)


def label_table(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Labels (``col``) and their index ``name``: 0.0 for the most frequent one, equally
    frequent ones in alphabetical order.  Nulls have none.

    Labels are counted, sorted into ranges and numbered there, so there may be as many as
    rows; none of them passes the driver.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    name = name or f"{col}_index"
    numbered = ranking.sequential_id(counts, [F.desc("_n"), F.col(col).cast("string")], start=0, name=name)
    return numbered.select(col, F.col(name).cast("double").alias(name))


def string_index(df: DataFrame, col: str, name: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Label index by falling frequency, then alphabetically; nulls are skipped.

    ``labels`` is a table that ``label_table`` made of other rows; rows with a label it
    does not have are skipped too.  The join is one on equal labels, whose hot side
    adaptive execution splits.
    """
    if labels is None:
        labels = label_table(df, col, name)
    index = next(c for c in labels.columns if c != col)
    return df.join(labels, col).select(*df.columns, F.col(index).alias(name or f"{col}_index"))


def segment(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = SEED, name: str = "segment") -> DataFrame:
    """k-means segments on standardised columns: one pipeline, one fit.  Rows with a
    null in a column have a null segment."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    stages = [*scaled_stages(cols), KMeans(k=k, seed=seed, featuresCol="features", predictionCol=name)]
    found = Pipeline(stages=stages).fit(df).transform(df.filter(known)).drop("features_raw", "features")
    return found.unionByName(df.filter(~known).withColumn(name, F.lit(None).cast("int")))


def hash_split(df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, salt: str = "split") -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows by a hash of the key, the same on every run."""
    inside = draws.hash_fraction(*keys, salt=salt) < F.lit(share)
    return df.filter(inside), df.filter(~inside)


def _classifier(config: ModelConfig, label: str):
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction", **config.params}
    kind = config.type
    if kind == "logistic":
        return LogisticRegression(**{"maxIter": LOGISTIC_ITERATIONS, **common})
    if kind == "random_forest":
        return RandomForestClassifier(**{"seed": SEED, **common})
    if kind in ("gbt", "xgboost"):
        return GBTClassifier(**{"maxIter": BOOSTING_ROUNDS, "seed": SEED, **common})
    if kind == "mlp":
        layers = [len(config.features), *HIDDEN_LAYERS, 2]
        return MultilayerPerceptronClassifier(**{"layers": layers, "seed": SEED, **common})
    raise ValueError(f"unknown model type {kind!r}")


def probability(col: str = "probability", index: int = 1) -> Column:
    """One element of a probability vector."""
    return vector_to_array(F.col(col))[index]


def train_models(df: DataFrame, configs: Mapping[str, ModelConfig], keys: Sequence[str],
                 share: float = TRAIN_SHARE) -> dict[str, TrainedModel]:
    """Train each configured model and evaluate it on held-out rows.

    Rows with a null in a model's columns are quarantined for that model.  The columns
    the models need are written down once: every fit and every later look at
    predictions reads the same rows, also after an executor is lost.
    """
    needed = [c for m in configs.values() for c in (*m.features, m.target)]
    shared = pin(df.select(*dict.fromkeys([*keys, *needed])))
    return {name: _train(shared, c, keys, share) for name, c in configs.items()}


def _train(df: DataFrame, config: ModelConfig, keys: Sequence[str], share: float) -> TrainedModel:
    needed = [*keys, *config.features, config.target]
    ready, bad = quarantine(df.select(*dict.fromkeys(needed)), [*config.features, config.target])
    train, held_out = hash_split(ready, keys, share)
    counts = {"n_train": train.count(), "n_held_out": held_out.count(), "n_quarantined": bad.count()}
    labels, label = None, config.target
    if isinstance(df.schema[config.target].dataType, StringType):
        label = f"{config.target}_indexed"
        labels = pin(label_table(train, config.target, label))
        train, held_out = (pin(string_index(part, config.target, label, labels)) for part in (train, held_out))
    model = Pipeline(stages=[*scaled_stages(config.features), _classifier(config, label)]).fit(train)
    predictions = model.transform(held_out)
    scored = evaluate(predictions, label, "prediction", None if config.multiclass else "rawPrediction")
    scored = scored.withColumns({k: F.lit(v).cast("bigint") for k, v in counts.items()})
    return TrainedModel(model, predictions, scored, bad, confusion_table(predictions, label), labels)


def confusion_table(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per label and prediction, nulls included."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """Weighted precision, recall and F1 as one row, from one pass.

    Predictions are combined to counts per (label, prediction) before anything
    is divided, so hot classes cost nothing.
    """
    pairs = pred.groupBy(F.col(label).cast("double").alias("a"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("n_label"), F.lit(0).cast("bigint").alias("n_pred"),
                         F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("n_hit")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("n_label"), F.col("n").alias("n_pred"),
                         F.lit(0).cast("bigint").alias("n_hit")),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("c").agg(
        F.sum("n_label").alias("n_label"), F.sum("n_pred").alias("n_pred"), F.sum("n_hit").alias("n_hit")
    )
    precision = F.coalesce(F.try_divide("n_hit", "n_pred"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("n_hit", "n_label"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(precision * recall * 2, precision + recall), F.lit(0.0))
    n = F.sum("n_label")
    return classes.agg(
        n.alias("n_rows"),
        (F.sum(precision * F.col("n_label")) / n).alias("weighted_precision"),
        (F.sum(recall * F.col("n_label")) / n).alias("weighted_recall"),
        (F.sum(f1 * F.col("n_label")) / n).alias("weighted_f1"),
    )


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction", score: str | None = "rawPrediction") -> DataFrame:
    """Classification metrics as one row; the area under the ROC curve is null
    for a multiclass model (no ``score``)."""
    auc = None
    if score is not None:
        auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=0).evaluate(pred)
    return classification_metrics(pred, label, prediction).withColumn("auc", F.lit(auc).cast("double"))


def blend_scores(base: DataFrame, key: str, scores: Mapping[str, DataFrame],
                 weights: Mapping[str, float] | None = None, name: str = "score") -> DataFrame:
    """Weighted sum of model scores for every client of ``base``.

    ``scores`` maps a score column to a frame of (key, that column).  A client
    with any score missing has none, and is routed by label.
    """
    weights = weights or BLEND_WEIGHTS
    out = base.select(key).distinct()
    for column, frame in scores.items():
        out = out.join(frame.select(key, column), on=key, how="left")
    blended = sum((F.col(c) * F.lit(weights[c]) for c in scores), F.lit(0.0))
    return out.withColumn(name, blended).withColumn(
        "routing", F.when(F.col(name).isNotNull(), F.lit(COMPLETE)).otherwise(F.lit(INCOMPLETE))
    )
