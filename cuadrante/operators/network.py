"""A small feed-forward network trained by mini-batches over all rows, in shards.

Every epoch each shard goes through its rows in small batches with Adam, from the same
weights; Spark sums the shards' weights and moments, weighted by rows, and the averages
begin the next epoch.  A task holds one Arrow batch and the weights, whose number depends
on the layers alone.  Rows are dealt and ordered by hashes of their values, and dropout
draws come from the epoch and the shard, so a job gives the same network on every run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.session import pin

# Layers, epochs, rows of a step, learning rate and dropout of the first layer.
HIDDEN = (16, 8)
EPOCHS = 10
BATCH = 64
RATE = 0.005
DROPOUT = 0.2
SHARD_ROWS = 500_000  # rows a shard has, about
DECAY = (0.9, 0.999)


@dataclass(frozen=True)
class Network:
    """Weights of each layer (inputs + 1 rows, the last being the bias), and the means and
    deviations its inputs are scaled by."""

    features: Sequence[str]
    layers: tuple[np.ndarray, ...]
    means: np.ndarray
    deviations: np.ndarray


def _cut(flat: np.ndarray, shapes: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    ends = np.cumsum([a * b for a, b in shapes])
    return [part.reshape(shape) for part, shape in zip(np.split(flat, ends[:-1]), shapes)]


def _forward(x: np.ndarray, layers: Sequence[np.ndarray], keep: np.ndarray | None = None) -> list[np.ndarray]:
    """Values of every layer, the inputs first and the probability last; ``keep`` scales the
    first hidden layer's units (0 for those that are left out)."""
    out = [x]
    for i, w in enumerate(layers):
        z = out[-1] @ w[:-1] + w[-1]
        last = i == len(layers) - 1
        z = 1 / (1 + np.exp(-np.clip(z, -40, 40))) if last else np.maximum(z, 0)
        out.append(z * keep if keep is not None and i == 0 and not last else z)
    return out


def _gradient(x: np.ndarray, y: np.ndarray, layers: Sequence[np.ndarray], keep: np.ndarray | None) -> np.ndarray:
    """Slope of the mean cross entropy, as one flat array."""
    values = _forward(x, layers, keep)
    slope, parts = (values[-1] - y[:, None]) / len(y), []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.vstack([values[i].T @ slope, slope.sum(0)]).ravel())
        if i:
            slope = (slope @ layers[i][:-1].T) * (values[i] > 0)
            if i == 1 and keep is not None:
                slope = slope * keep
    return np.concatenate(parts[::-1])


def _shard_epoch(shapes, state, epoch: int, steps: int, dropout: float, rate: float, batch: int, seed: int):
    """A function that goes through the batches of a shard once and returns its weights and
    moments, with the number of its rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, first, second = (a.copy() for a in state)
        rows, at, rest, draw = 0, steps, None, None
        for frame in frames:
            if draw is None and len(frame):
                draw = np.random.default_rng([seed, epoch, int(frame["_shard"].iloc[0])])
            block = np.column_stack([np.vstack(frame["_x"].to_numpy()), frame["_y"].to_numpy(dtype=float)]) if len(frame) else None
            if block is None:
                continue
            rest = block if rest is None else np.vstack([rest, block])
            # What is left of a frame waits for the next one, so frames do not matter.
            full = len(rest) // batch * batch
            for piece in [*(rest[i : i + batch] for i in range(0, full, batch))]:
                weights, first, second, at = _step(piece, shapes, weights, first, second, at, dropout, rate, draw)
                rows += len(piece)
            rest = rest[full:]
        if rest is not None and len(rest):
            weights, first, second, at = _step(rest, shapes, weights, first, second, at, dropout, rate, draw)
            rows += len(rest)
        if rows:
            yield pd.DataFrame({"place": np.arange(len(weights)), "w": weights * rows, "m": first * rows, "v": second * rows, "n": rows, "steps": at})

    return run


def _step(piece, shapes, weights, first, second, at, dropout, rate, draw):
    x, y = piece[:, :-1], piece[:, -1]
    keep = (draw.random((len(x), shapes[0][1])) >= dropout) / (1 - dropout) if dropout else None
    slope = _gradient(x, y, _cut(weights, shapes), keep)
    at += 1
    first = DECAY[0] * first + (1 - DECAY[0]) * slope
    second = DECAY[1] * second + (1 - DECAY[1]) * slope**2
    scaled = (first / (1 - DECAY[0] ** at)) / (np.sqrt(second / (1 - DECAY[1] ** at)) + 1e-8)
    return weights - rate * scaled, first, second, at


def train_network(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], hidden: Sequence[int] = HIDDEN, epochs: int = EPOCHS,
    batch: int = BATCH, rate: float = RATE, dropout: float = DROPOUT, shards: int | None = None, seed: int = 42,
) -> Network:
    """Fit a network for the 0/1 column ``label``.  Rows with a null (or NaN) among the
    columns are passed over; without any row left this raises ValueError.  A constant
    column adds nothing.  ``keys`` names each row: rows are dealt to ``shards`` by their
    keys and values, by default one for each ``SHARD_ROWS`` rows.  Rows that repeat in all
    of these go to one shard, which then takes longer but no more memory.
    """
    columns = [F.col(c).cast("double") for c in (*features, label)]
    known = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in columns])
    place = F.xxhash64(*[F.col(k) for k in keys], *columns)
    rows = pin(df.filter(known).select(F.array(*columns[:-1]).alias("_x"), columns[-1].alias("_y"), place.alias("_place")))
    figures = [f for i in range(len(features)) for f in (F.avg(F.col("_x")[i]), F.stddev_samp(F.col("_x")[i]))]
    n, *moments = rows.agg(F.count(F.lit(1)), *figures).first()
    if not n:
        raise ValueError("train_network: no row without a null")
    means = np.array(moments[::2])
    deviations = np.array([s or 1.0 for s in moments[1::2]])
    shards = shards or -(-n // SHARD_ROWS)
    scaled = F.transform("_x", lambda x, i: (x - F.get(F.lit(means.tolist()), i)) / F.get(F.lit(deviations.tolist()), i))
    dealt = rows.select(scaled.alias("_x"), "_y", "_place", F.pmod("_place", F.lit(shards)).cast("int").alias("_shard"))

    sizes = [len(features), *hidden, 1]
    shapes = [(a + 1, b) for a, b in zip(sizes, sizes[1:])]
    draw = np.random.default_rng(seed)
    start = [np.vstack([draw.uniform(-1, 1, (a - 1, b)), np.zeros((1, b))]) * np.sqrt(6 / (a - 1 + b)) for a, b in shapes]
    weights = np.concatenate([w.ravel() for w in start])
    state, steps = (weights, np.zeros_like(weights), np.zeros_like(weights)), 0
    for epoch in range(epochs):
        # A partition may hold several shards where their hashes meet; it is one shard then.
        ordered = dealt.repartition(shards, "_shard").sortWithinPartitions(F.xxhash64("_place", F.lit(epoch)), "_place")
        run = _shard_epoch(shapes, state, epoch, steps, dropout, rate, batch, seed)
        out = ordered.select("_x", "_y", "_shard").mapInPandas(run, "place int, w double, m double, v double, n long, steps long")
        # One row per weight comes to the driver, however many shards there are.
        sums = out.groupBy("place").agg(F.sum("w"), F.sum("m"), F.sum("v"), F.sum("n"), F.max("steps")).orderBy("place").collect()
        table = np.array([r[1:] for r in sums], dtype=float)
        state, steps = tuple((table[:, i] / table[:, 3]) for i in range(3)), int(table[0, 4])
    return Network(tuple(features), tuple(_cut(state[0], shapes)), means, deviations)


def network_probability(network: Network) -> Column:
    """The network's probability of label 1; null where a feature is null or NaN."""
    layers, means, deviations = network.layers, network.means, network.deviations

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        known = ~np.isnan(x).any(axis=1)
        out = np.full(len(x), np.nan)
        out[known] = _forward((x[known] - means) / deviations, layers)[-1][:, 0]
        return pd.Series(out).where(known, None)

    return score(*[F.col(c).cast("double") for c in network.features])
