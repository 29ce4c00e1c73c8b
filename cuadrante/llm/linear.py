"""Logistic regression over sparse features, fitted in shards by
follow-the-regularised-leader updates on a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadrante.llm.common import hash_share
from cuadrante.llm.words import text_bytes
from cuadrante.llm.worker import give_back, lean
from cuadrante.session import pin

Features = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


class Ftrl:
    """Several logistic regressions under proximal updates, one per output."""

    def __init__(self, size: int, outputs: int, alpha: float = 2.0, beta: float = 0.1, l1: float = 1e-5, l2: float = 1e-4):
        self.z, self.n = np.zeros((size, outputs)), np.zeros((size, outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i=slice(None)) -> np.ndarray:
        z = self.z[i]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        w = self.weights(i)
        g = x[:, None] * (probability(x @ w) - y)
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def probability(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def draw_sample(labelled: DataFrame, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, or all where there are fewer: rows whose
    hashed id lies below that share.  ``labelled`` has ``doc_id``; an id counts once."""
    labelled = labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    counts = pin(labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    drawn = labelled.join(counts, label).filter(hash_share("doc_id") * F.col("_n") < per_label)
    return pin(drawn.select("doc_id", label))


def _examples(features: Features, outputs: int):
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.list_(pa.float64())), ("i", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                found = [features(b) for b in text_bytes(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.list_(pa.float64())), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.list_(pa.float64()))], schema=schema
                )

    return lean(run)


def _fit_shard(size: int, outputs: int, epochs: int, settings: dict):
    schema = pa.schema([("i", pa.int32()), ("w", pa.list_(pa.float64()))])

    def run(table: pa.Table) -> pa.Table:
        give_back()
        table = table.sort_by("doc_id").combine_chunks()
        order = np.random.default_rng(7).permutation(table.num_rows)
        y = np.array(table["y"].to_pylist()).reshape(-1, outputs)
        index, value = table["i"].chunk(0), table["x"].chunk(0)
        rows = [(np.append(index[j].values.to_numpy(), size), np.append(value[j].values.to_numpy(), 1.0)) for j in range(table.num_rows)]
        model = Ftrl(size + 1, outputs, **settings)
        for _ in range(epochs):
            for j in order:
                model.learn(*rows[j], y[j])
        w = model.weights()
        used = np.flatnonzero(w.any(axis=1)).astype(np.int32)
        return pa.Table.from_arrays([pa.array(used), pa.array(list(w[used]), pa.list_(pa.float64()))], schema=schema)

    return run


def fit(docs: DataFrame, targets: DataFrame, features: Features, size: int, outputs: int, shards: int, epochs: int, **settings: float) -> np.ndarray:
    """Weights (size + 1 rows, the last for the constant; one column per output).

    ``docs`` is (doc_id, text), ``targets`` the drawn sample: (doc_id, y) with an array
    of zeros and ones.  Each shard of the sample learns on its own; their weights are
    averaged.  The result is bounded by ``size`` whatever the corpus.
    """
    examples = docs.join(F.broadcast(targets), "doc_id").select("doc_id", "y", "text")
    examples = pin(examples.mapInArrow(_examples(features, outputs), "doc_id long, y array<double>, i array<int>, x array<double>"))
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards))
    parts = examples.withColumn("shard", shard).groupBy("shard").applyInArrow(lambda t: _fit_shard(size, outputs, epochs, settings)(t.drop_columns(["shard"])), "i int, w array<double>")
    used = max(1, examples.select(shard).distinct().count())
    mean = parts.select("i", F.posexplode("w").alias("k", "w")).groupBy("i", "k").agg((F.sum("w") / used).alias("w"))
    got = mean.toArrow()
    out = np.zeros((size + 1, outputs))
    out[got["i"].to_numpy(), got["k"].to_numpy()] = got["w"].to_numpy()
    return out
