"""Word hashes of whole Arrow batches, without a Python object per word.

A word is a run of bytes other than blank, tab, line and form feeds (0x20, 0x09 to
0x0D), which in UTF-8 is the same as a run of such characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18  # bytes hashed at once
_RNG = np.random.default_rng(20_240_607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[BLANK] = 0
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z only
_BASE = 0x9E3779B97F4A7C15
_MOD = 1 << 64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, SLICE), _powers(pow(_BASE, -1, _MOD), SLICE)


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed shuffle of 64-bit values in which every bit depends on every other."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _hash_slice(b: np.ndarray, first: np.ndarray) -> np.ndarray:
    v = _BYTE[b]
    n = len(b)
    up, down = (_UP, _DOWN) if n <= SLICE else (_powers(_BASE, n), _powers(pow(_BASE, -1, _MOD), n))
    v *= up[:n]
    return mix(np.add.reduceat(v, first) * down[first])


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in a text's bytes."""
    word = np.empty(len(b) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(BLANK[b], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def text_words(b: np.ndarray, fold: bool = True) -> np.ndarray:
    """One hash per word of a text given as bytes, in order.  ``fold`` makes A-Z lower."""
    if fold:
        b = FOLD[b]
    first, _ = word_spans(b)
    if not len(first):
        return np.empty(0, np.uint64)
    if len(b) <= SLICE:
        return _hash_slice(b, first)
    out, at = [], 0
    while at < len(first):  # cut long texts between words
        last = max(at + 1, int(np.searchsorted(first, first[at] + SLICE - 1)))
        stop = first[last] if last < len(first) else len(b)
        if stop - first[at] > SLICE and last - at > 1:
            last -= 1
            stop = first[last]
        out.append(_hash_slice(b[first[at] : stop], first[at:last] - first[at]))
        at = last
    return np.concatenate(out)


def text_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    none = texts.is_null().to_numpy(zero_copy_only=False) if texts.null_count else None
    for i in range(len(texts)):
        yield raw[:0] if none is not None and none[i] else raw[offs[i] : offs[i + 1]]


_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25], np.uint64)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    last = len(words) - n + 1
    out = words[:last] * _PLACE[0]
    for k in range(1, n):
        out += words[k : last + k] * _PLACE[k]
    return mix(out)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The distinct runs of ``n`` words, sorted; a shorter text is one run of its own
    length, a text without words has none."""
    if not len(words):
        return words
    if len(words) < n:
        return ngrams(words, len(words)) ^ np.uint64(len(words))
    return np.unique(ngrams(words, n))
