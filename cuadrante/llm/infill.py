"""Fill-in-middle transformation of documents.

Cuts are counted in code points but made in bytes.  The UTF-8 bytes of many texts at
once are seen as 64-bit words.  Arithmetic on a word marks each byte that ends a code
point, ``bitwise_count`` gives the marks of a word, and their running sum is searched
for the word that holds the wanted mark; the byte in it follows from the running sum
within the word, which is one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20

BLOCK = 1 << 22  # bytes of texts that are marked at once, or one text
_ONES = np.uint64(0x0101010101010101)  # 1 in each byte
_HIGH = np.uint64(0x8080808080808080)  # the high bit of each byte


class UnitEnds:
    """The bytes that end a code point, over the bytes of whole texts."""

    def __init__(self, data: np.ndarray):
        words = np.zeros(-(-len(data) // 8) + 1, "<u8")  # zero bytes follow, which start units
        words.view(np.uint8)[: len(data)] = data
        # A byte 10xxxxxx goes on with its unit, any other starts one ...
        starts = _HIGH & ~(words & ~(words << np.uint64(1)))
        # ... so the byte before a start ends one.
        self.marks = (starts[:-1] >> np.uint64(8)) | (starts[1:] << np.uint64(56))
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.marks = np.append(self.marks, np.uint64(0))

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many units end before byte ``at``."""
        word, inside = at >> 3, (at & 7).astype(np.uint64) * np.uint64(8)
        low = (np.uint64(1) << inside) - np.uint64(1)
        return self.upto[word] + np.bitwise_count(self.marks[word] & low)

    def after(self, units: np.ndarray) -> np.ndarray:
        """The byte that follows the first ``units`` units, all told from the start."""
        word = np.maximum(np.searchsorted(self.upto, units, side="left") - 1, 0)
        left = (units - self.upto[word]).astype(np.uint64)
        sums = (self.marks[word] >> np.uint64(7)) * _ONES  # of the marks up to each byte
        enough = ((sums | _HIGH) - left * _ONES) & _HIGH
        return np.where(units > 0, 8 * word + 9 - np.bitwise_count(enough).astype(np.int64), 0)


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``BLOCK`` bytes, or of one text."""
    first, last = 0, len(offsets) - 1
    while first < last:
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1)
        yield first, stop
        first = stop


def _plain_texts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Which texts are empty or hold a mark of the format themselves."""
    plain = offsets[1:] == offsets[:-1]
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = data.find(mark.encode())
        while at >= 0:
            k = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(mark) <= offsets[k + 1]:
                plain[k] = True
                at = data.find(mark.encode(), int(offsets[k + 1]))
            else:  # it lies across two texts
                at = data.find(mark.encode(), at + 1)
    return plain


def _cut(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, plain_percent: int, spm_percent: int):
    """Outputs, forms, sizes in units and cuts of one block; ``draws`` has four columns."""
    ends = UnitEnds(data)
    raw = data.tobytes()
    before = ends.before(offsets)
    n = np.diff(before)
    plain = _plain_texts(raw, offsets) | (draws[:, 2] % 100 >= 100 - plain_percent)
    spm = draws[:, 3] % 100 < spm_percent
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    a, b = (ends.after(before[:-1] + cuts[:, k]) for k in (0, 1))
    a, b = np.maximum(a, offsets[:-1]), np.maximum(b, offsets[:-1])
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out = []
    for one, other, i, j, stop, start in zip(plain.tolist(), spm.tolist(), a.tolist(), b.tolist(), offsets[1:].tolist(), offsets[:-1].tolist()):
        if one:
            out.append(raw[start:stop])
        elif other:
            out.append(b"".join((s, raw[j:stop], p, raw[start:i], m, raw[i:j])))
        else:
            out.append(b"".join((p, raw[start:i], s, raw[j:stop], m, raw[i:j])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return out, form, n, plain, cuts


def _transform(plain_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            _, offsets, data = texts.buffers()
            all_offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
            draws = np.stack([batch.column(k).to_numpy() for k in range(2, 6)], axis=1)
            for first, stop in _blocks(all_offsets):
                at = all_offsets[first : stop + 1]
                out, form, n, plain, cuts = _cut(raw[at[0] : at[-1]], at - at[0], draws[first:stop], plain_percent, spm_percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        pa.array(n, pa.int64()),
                        pa.array(form.tolist(), pa.string()),
                        pa.array(cuts[:, 0], pa.int64(), mask=plain),
                        pa.array(cuts[:, 1] - cuts[:, 0], pa.int64(), mask=plain),
                        pa.array(out, pa.string()),
                    ],
                    names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n`` (code points), ``form`` (plain, psm or
    spm), ``prefix_chars``, ``middle_chars`` (null if plain) and the whole ``output``.

    Draws are the first four groups of eight digits of the hex sha256 of ``seed:id``, so a
    row's cuts do not depend on the run.  Null text counts as empty and stays plain, as
    does a text that holds a mark of the format; a null id is hashed as no digits.  Rows
    that repeat an id are cut by the same draws; an empty table gives no rows; other
    columns are left out.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"_h{k}") for k in range(4)]
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), digest.alias("_digest")).select("_id", "_text", *draws)
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(_transform(plain_percent, spm_percent), f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("_id", id_col)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of."""
    parts = F.split(F.col(output), "<[PSM]>")  # nothing stands before the first mark
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
