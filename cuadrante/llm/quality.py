"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadrante.llm import linear
from cuadrante.llm.common import text_column
from cuadrante.llm.words import BLANK, ngrams, text_bytes, text_words, word_spans
from cuadrante.llm.worker import lean

BITS = 18
PER_LABEL = 4_000  # labelled rows of either label that a model is fitted on, about
SHARDS = 4
EPOCHS = 4

# What a byte tells about the shape of its word.
_KIND = np.full(256, 1, np.uint16)  # letters and all bytes of other alphabets
_KIND[:128] = 64
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
_KIND[[ord(c) for c in "!?"]] = 8
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 16
_KIND[[ord(c) for c in "#*$%&|<>"]] = 32
_KIND[BLANK] = 0
_AGAIN, _AGAIN2, _LONG = 128, 256, 512


def features(b: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text's bytes: indices, ascending, and values.

    There are three families: words, pairs of words, and runs of one to three word
    shapes.  A shape is the kinds of characters in a word, whether it is long and
    whether it repeats the word before or the one before that.  Values are shares of
    the family, so the length of a text does not matter.
    """
    words = text_words(b)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0)
    first, last = word_spans(b)
    shape = np.bitwise_or.reduceat(_KIND[b], first)
    shape = shape | np.where(last - first > 12, np.uint16(_LONG), np.uint16(0))
    shape[1:] |= np.where(words[1:] == words[:-1], np.uint16(_AGAIN), np.uint16(0))
    shape[2:] |= np.where(words[2:] == words[:-2], np.uint16(_AGAIN2), np.uint16(0))
    shape = shape.astype(np.uint64) + np.uint64(1)
    keys, values = [], []
    for family, hashes in enumerate((words, ngrams(words, 2), ngrams(shape, 1), ngrams(shape, 2), ngrams(shape, 3))):
        if len(hashes):
            h = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (family + 1) % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
            keys.append((h >> np.uint64(64 - bits)).astype(np.int64))
            values.append(np.full(len(h), 1.0 / len(h)))
    index, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return index, np.bincount(inverse, np.concatenate(values))


def fit_quality(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, bits: int = BITS) -> np.ndarray:
    """Weights from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    The fit takes about ``per_label`` rows of each label.  Null ids and labels are left
    out; an id with several labels counts with the largest.  Without labels of both
    kinds all weights are 0 and every score 0.5.
    """
    labels = labels.select("doc_id", F.col("label").cast("double").alias("label"))
    sample = linear.draw_sample(labels, "label", per_label)
    drawn = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two labels
    if len(drawn) < 2:
        return np.zeros(((1 << bits) + 1, 1))
    rows = docs.select(F.col("doc_id"), F.col("text"))
    return linear.fit(rows, sample.select("doc_id", F.array("label").alias("y")), lambda b: features(b, bits), 1 << bits, 1, SHARDS, EPOCHS)


def score_quality(docs: DataFrame, weights: np.ndarray, bits: int = BITS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``score``, the chance of label 1, from the whole text of each row.

    Null and empty texts have no features and get the score of the constant alone.  Rows
    are kept as they come, repeated ones too; columns that are not carried are left out;
    an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights[:, 0])
    kinds = docs.select(*carry).schema
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in kinds)}, score double"

    own, at = text_column(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            found = (features(b, bits) for b in text_bytes(batch.column(at)))
            scores = [float(linear.probability(w[i] @ x + w[-1])) for i, x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(scores, pa.float64())], names=[*carry, "score"])

    return docs.select(*carry, *own).mapInArrow(lean(run), schema)
