"""Small helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table of at most this many narrow rows (some 16 MB) may be sent to every executor.
BROADCAST_ROWS = 1_000_000


def bounded(pinned: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``pinned`` with a broadcast hint if it was counted to have at most ``rows``
    rows; a larger table stays as it is and is joined by a shuffle."""
    return F.broadcast(pinned) if pinned.limit(rows + 1).count() <= rows else pinned


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def hash_share(*cols: Column) -> Column:
    """A fixed number in [0, 1) for each value: a reproducible draw."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def text_column(carry: tuple[str, ...], text: str = "text") -> tuple[list[Column], int]:
    """What to select beside ``carry`` for a task to see the text, and the place where it
    does: a text that is carried anyway is not sent twice."""
    if text in carry:
        return [], carry.index(text)
    return [F.col(text).alias("_text")], len(carry)
