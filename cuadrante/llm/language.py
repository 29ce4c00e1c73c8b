"""Language identification by error-correcting output codes.

Each language has a codeword; each bit is predicted by a logistic regression over
hashed byte n-grams.  The losses of a codeword's bits, weighted by how well each bit
is known for that language, decide which codeword is nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadrante.llm import linear
from cuadrante.llm.common import text_column
from cuadrante.llm.words import text_bytes
from cuadrante.llm.worker import lean
from cuadrante.session import pin

BITS = 14
PER_LANGUAGE = 1_500  # documents of each language that a model is fitted on, about
MAX_LANGUAGES = 500
SHARDS = 4
EPOCHS = 3
CHUNK = 1 << 20  # bytes counted at once
UNKNOWN = "und"

# Letters keep their case-folded bytes, all else in ASCII is a gap.
_FOLD = np.full(256, 32, np.uint64)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # one row of +1 and -1 per language
    trust: np.ndarray  # weight of each bit for each language, rows sum to 1
    weights: np.ndarray


def codewords(k: int) -> np.ndarray:
    """A row per class.  Up to five classes: every way to part them in two.  Beyond: 31
    bits or more, the most spread of a fixed number of draws."""
    if k <= 5:
        return np.array([[1 if (c == 0 or (bit >> (c - 1)) & 1) else -1 for bit in range(2 ** (k - 1) - 1)] for c in range(k)], float).reshape(k, -1)
    bits, rng, best, spread = max(31, 6 * int(np.ceil(np.log2(k)))), np.random.default_rng(31), None, -1
    for _ in range(100):
        code = np.where(rng.random((k, bits)) < 0.5, -1.0, 1.0)
        far = int(((bits - code @ code.T) / 2 + bits * np.eye(k)).min())
        if far > spread and (np.abs(code.sum(axis=0)) < k).all():
            best, spread = code, far
    return best


def counts(b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Shares of hashed two- and three-byte runs in a text, dense."""
    out = np.zeros(1 << bits)
    shift = np.uint64(64 - bits)
    for at in range(0, len(b), CHUNK):
        v = _FOLD[b[at : at + CHUNK + 2]]
        pair = v[:-1] * np.uint64(256) + v[1:]
        three = pair[:-1] * np.uint64(256) + v[2:] + np.uint64(1 << 40)
        pair = pair[: len(b[at : at + CHUNK])]
        for h in (pair, three):
            out += np.bincount(((h * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64), minlength=1 << bits)
    total = out.sum()
    return out / total if total else out


def features(b: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    dense = counts(b, bits)
    i = np.flatnonzero(dense)
    return i, dense[i] * 10


def has_letter(b: np.ndarray) -> bool:
    if ((b | 32) - 97 < 26).any():
        return True
    return bool((b >= 128).any()) and any(c.isalpha() for c in b.tobytes().decode("utf-8", "replace"))


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE, bits: int = BITS) -> Model:
    """A model from ``docs`` (doc_id, text, lang); rows with a null in any of them are
    left out, as are texts without a letter.  The languages are the distinct values of
    ``lang`` and must be few."""
    known = docs.filter("doc_id is not null and text is not null and lang is not null")
    names = [r[0] for r in known.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    code = codewords(len(names)) if names else np.zeros((0, 0))
    if len(names) < 2:
        return Model(names, code, code, np.zeros(((1 << bits) + 1, 0)))
    sample = linear.draw_sample(known.select("doc_id", "lang"), "lang", per_language)
    rows = docs.sparkSession.createDataFrame([(n, [float(x > 0) for x in c]) for n, c in zip(names, code)], "lang string, y array<double>")
    targets = pin(sample.join(F.broadcast(rows), "lang").select("doc_id", "y", "lang"))
    weights = linear.fit(known.select("doc_id", "text"), targets.select("doc_id", "y"), lambda b: features(b, bits), 1 << bits, code.shape[1], SHARDS, EPOCHS)
    model = Model(names, code, np.full(code.shape, 1 / code.shape[1]), weights)
    # How often each bit is right for each language, on the sample.
    margins = known.join(F.broadcast(targets.select("doc_id", F.col("lang").alias("_lang"))), "doc_id").select(F.col("_lang").alias("lang"), F.col("text"))
    right = _bits_right(margins, model, bits).groupBy("lang", "bit").agg(F.sum("right").alias("r"), F.count(F.lit(1)).alias("n")).collect()  # languages x bits
    trust = np.full(code.shape, 0.5)
    for r in right:
        trust[names.index(r["lang"]), r["bit"]] = (r["r"] + 1) / (r["n"] + 2)
    return model._replace(trust=trust / trust.sum(axis=1, keepdims=True))


def _margins(b: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    return 10 * counts(b, bits) @ weights[:-1] + weights[-1]


def _bits_right(rows: DataFrame, model: Model, bits: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            langs, n = batch.column(0).to_pylist(), m.code.shape[1]
            right = [(_margins(b, m.weights, bits) * m.code[m.languages.index(x)] > 0) for x, b in zip(langs, text_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(langs, object), n), pa.string()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(langs))), pa.array(np.concatenate(right).astype(np.int32) if right else [], pa.int32())], names=["lang", "bit", "right"]
            )

    return rows.mapInArrow(lean(run), "lang string, bit int, right int")


def decode(margins: np.ndarray, model: Model) -> tuple[int, float]:
    """The nearest codeword and how sure it is among all, from 0 to 1."""
    loss = (model.trust * np.logaddexp(0, -model.code * margins)).sum(axis=1) * model.code.shape[1]
    chance = np.exp(loss.min() - loss)
    return int(loss.argmin()), float(1 / chance.sum())


def identify(docs: DataFrame, model: Model, bits: int = BITS, min_score: float = 0.6, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, ``lang_pred``, ``score`` and ``ambiguous`` of each row's whole text.

    Null texts and texts without a letter are ``und`` with score 0, as is any text when
    no language was learned.  ``ambiguous`` marks scores below ``min_score``.  Rows are
    kept as they come, repeated ones too; columns that are not carried are left out; an
    empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model._replace(weights=model.weights.astype(np.float64)))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.select(*carry).schema)}, lang_pred string, score double, ambiguous boolean"

    own, at = text_column(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            names, scores = [], []
            for b in text_bytes(batch.column(at)):
                if not m.languages or not has_letter(b):
                    name, score = UNKNOWN, 0.0
                elif len(m.languages) == 1:
                    name, score = m.languages[0], 1.0
                else:
                    k, score = decode(_margins(b, m.weights, bits), m)
                    name = m.languages[k]
                names.append(name)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carry)], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([s < min_score for s in scores], pa.bool_())], names=[*carry, "lang_pred", "score", "ambiguous"]
            )

    return docs.select(*carry, *own).mapInArrow(lean(run), schema)
