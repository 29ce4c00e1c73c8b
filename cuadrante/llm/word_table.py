"""Token ids of whole Arrow batches by a table of words.

Where a tokenizer never joins what stands on the two sides of a place, the parts can be
encoded apart.  Each part of at most ``KEY_BYTES`` bytes is its own key, read as 64-bit
words, so parts are told apart exactly.  The table has a fixed number of places, two for
each key, and new words take the place of older ones: its size does not grow with the
corpus, and words that come late are kept as well as early ones.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from cuadrante.llm.words import FOLD, mix

PLACES = 1 << 21
KEY_BYTES = 24
KEPT_IDS = 12  # of a part; parts of more ids are encoded whenever they come
PARTS = 1 << 18  # looked up at once
ENCODED = 20_000  # parts given to the tokenizer at once
BLOCK = 1 << 21  # bytes of texts that are cut at once, or one text
LINES = 500
# A blank and then neither blanks, controls nor what may begin a blank of several bytes:
# before and after such a part a line feed is a token of its own.
_LINE = re.compile(rb" [^\x00-\x20\x7f\xc2\xe1-\xe3]+")
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

Cut = tuple[np.ndarray, np.ndarray]


def before_blanks(data: np.ndarray, offsets: np.ndarray) -> Cut:
    """Parts of all bytes, each of blanks and what follows up to the next blanks.

    For byte-level tokenizers that part text into words with the blank before them.  A
    part never starts behind a control or a character that may be a blank itself.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    blank = _BLANK[data]
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    last = data[at - 1]
    lead2, lead3, lead4 = (data[np.maximum(at - k, 0)] for k in (2, 3, 4))
    wide = np.where(lead2 >= 0xC0, lead2 != 0xC2, np.where(lead3 >= 0xE0, lead3 >= 0xE4, lead4 >= 0xF0))
    starts = np.zeros(len(data), bool)
    starts[at[np.where(last < 0x80, last > 0x20, wide)]] = True
    starts[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    first = np.flatnonzero(starts)
    return first, np.append(first[1:], len(data))


def between_spaces(data: np.ndarray, offsets: np.ndarray) -> Cut:
    """Parts without blanks and line feeds, for tokenizers that drop these."""
    word = np.ones(len(data) + 1, bool)
    word[:-1] = (data != 0x20) & (data != 0x0A)
    word[-1] = False
    starts = word[:-1].copy()
    starts[1:] &= ~word[:-2]
    own = offsets[:-1][offsets[1:] > offsets[:-1]]
    starts[own] |= word[own]
    first = np.flatnonzero(starts)
    ends = word[:-1] & ~word[1:]
    ends[own[own > 0] - 1] |= word[own[own > 0] - 1]
    return first, np.flatnonzero(ends) + 1


def fold_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A-Z made lower in texts without a character from U+0300 on, for tokenizers that do
    so after composing marks: fewer words are then told apart."""
    rows = np.flatnonzero(offsets[1:] > offsets[:-1])
    if not len(rows):
        return data
    high = np.maximum.reduceat(data, offsets[rows]) >= 0xCC
    if not high.any():
        return FOLD[data]
    keep = np.zeros(len(offsets) - 1, bool)
    keep[rows[high]] = True
    return np.where(np.repeat(keep, np.diff(offsets)), data, FOLD[data])


class WordTable:
    """Ids by part; made once in a worker for each tokenizer."""

    made: dict[tuple, "WordTable"] = {}

    def __init__(self, path: str, cut: Callable[[np.ndarray, np.ndarray], Cut], fold: bool = False, places: int = PLACES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use all cores already
        from tokenizers import Tokenizer

        self.tokenizer, self.cut, self.fold = Tokenizer.from_file(path), cut, fold
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if cut is before_blanks and len(feed) == 1 else None
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.last = np.uint64(places - 1)
        self.keys = np.zeros((3, places), np.uint64)
        self.bytes = np.zeros(places, np.uint8)  # of the part, 0 where none is kept
        self.size = np.zeros(places, np.uint8)
        self.ids = np.zeros((places, KEPT_IDS), self.kind)

    @classmethod
    def of(cls, path: str, cut: Callable[[np.ndarray, np.ndarray], Cut], fold: bool = False, places: int = PLACES) -> "WordTable":
        key = (path, cut.__name__, fold, places)
        if key not in cls.made:
            cls.made.clear()
            cls.made[key] = cls(path, cut, fold, places)
        return cls.made[key]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (and the
        last one's end)."""
        if self.fold:
            data = fold_letters(data, offsets)
        first, stop = self.cut(data, offsets)
        padded = np.zeros(len(data) + KEY_BYTES + 8, np.uint8)
        padded[: len(data)] = data
        out, sizes = [], []
        for at in range(0, len(first), PARTS):
            ids, size = self._some(padded, first[at : at + PARTS], stop[at : at + PARTS])
            out.append(ids)
            sizes.append(size)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
        return np.concatenate(out) if out else np.empty(0, self.kind), ends[np.searchsorted(first, offsets)]

    def _some(self, data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = stop - first
        loads = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # eight bytes from each byte on
        keys = [loads[np.minimum(first + 8 * k, len(loads) - 1)] & _MASK[np.clip(width - 8 * k, 0, 8)] for k in range(3)]
        h = mix(keys[0] * _ODD[0] + keys[1] * _ODD[1] + keys[2] * _ODD[2] + width.astype(np.uint64) * _ODD[3])
        short = width <= KEY_BYTES
        place = (h & self.last).astype(np.int64)
        hit = short & self._holds(place, keys, width)
        rest = np.flatnonzero(short & ~hit)
        other = ((h[rest] >> np.uint64(32)) & self.last).astype(np.int64)
        found = self._holds(other, [k[rest] for k in keys], width[rest])
        place[rest[found]] = other[found]
        hit[rest[found]] = True

        size = np.zeros(len(first), np.int64)
        rows = np.zeros((len(first), KEPT_IDS), self.kind)
        size[hit], rows[hit] = self.size[place[hit]], self.ids[place[hit]]
        extra: list[tuple[int, np.ndarray]] = []
        new = np.flatnonzero(~hit)
        if len(new):
            which, reps = self._distinct(data, first, stop, keys, h, short, new)
            encoded = self._encoded([data[a:b].tobytes() for a, b in zip(first[reps].tolist(), stop[reps].tolist())])
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            all_ids = np.fromiter(chain.from_iterable(encoded), self.kind, int(lengths.sum()))
            nth = np.arange(len(all_ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = np.zeros((len(reps), KEPT_IDS), self.kind)
            kept[np.repeat(np.arange(len(reps)), lengths)[nth < KEPT_IDS], nth[nth < KEPT_IDS]] = all_ids[nth < KEPT_IDS]
            size[new], rows[new] = lengths[which], kept[which]
            extra = [(int(new[k]), np.array(encoded[which[k]][KEPT_IDS:], self.kind)) for k in np.flatnonzero(lengths[which] > KEPT_IDS)]
            self._keep(reps, keys, h, width, short, lengths, kept)
        flat = rows[np.arange(KEPT_IDS) < size[:, None]]
        if extra:
            upto = np.cumsum(np.minimum(size, KEPT_IDS))
            where = np.repeat(upto[[w for w, _ in extra]], [len(e) for _, e in extra])
            flat = np.insert(flat, where, np.concatenate([e for _, e in extra]))
        return flat, size

    def _holds(self, place: np.ndarray, keys: list[np.ndarray], width: np.ndarray) -> np.ndarray:
        out = self.bytes[place] == width
        for mine, key in zip(self.keys, keys):
            out &= mine[place] == key
        return out

    def _distinct(self, data, first, stop, keys, h, short, new) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``new`` parts its number among the distinct ones, and one part of each."""
        brief = short[new]
        some = new[brief]
        _, rep, inverse = np.unique(h[some], return_index=True, return_inverse=True)
        which = np.zeros(len(new), np.int64)
        which[brief] = inverse
        reps = some[rep]
        same = np.ones(len(new), bool)
        same[~brief] = False
        same[brief] = np.logical_and.reduce([k[some] == k[reps][inverse] for k in keys]) & ((stop - first)[some] == (stop - first)[reps][inverse])
        more: dict[bytes, int] = {}
        added = []
        for k in np.flatnonzero(~same).tolist():  # long parts, and hashes that two parts share
            w = new[k]
            part = data[first[w] : stop[w]].tobytes()
            if part not in more:
                more[part] = len(reps) + len(added)
                added.append(w)
            which[k] = more[part]
        return which, np.concatenate([reps, np.array(added, np.int64)])

    def _encoded(self, parts: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(parts)
        alone = range(len(parts))
        if self.feed is not None:  # several parts as lines of one text, which costs less than each alone
            plain = [k for k, p in enumerate(parts) if _LINE.fullmatch(p)]
            lines = [plain[at : at + LINES] for at in range(0, len(plain), LINES)]
            for own, ids in zip(lines, self._ids([b"\n".join([parts[k] for k in own]) for own in lines])):
                ends = [*(k for k, i in enumerate(ids) if i == self.feed), len(ids)]
                at = 0
                for k, end in zip(own, ends, strict=True):
                    out[k], at = ids[at:end], end + 1
            lined = set(plain)
            alone = [k for k in alone if k not in lined]
        for k, ids in zip(alone, self._ids([parts[k] for k in alone])):
            out[k] = ids
        return out

    def _ids(self, texts: list[bytes]) -> Iterator[list[int]]:
        for at in range(0, len(texts), ENCODED):
            for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts[at : at + ENCODED]], add_special_tokens=False):
                yield e.ids

    def _keep(self, reps, keys, h, width, short, lengths, kept) -> None:
        fit = np.flatnonzero(short[reps] & (lengths <= KEPT_IDS) & (width[reps] > 0))
        w = reps[fit]
        place = (h[w] & self.last).astype(np.int64)
        other = ((h[w] >> np.uint64(32)) & self.last).astype(np.int64)
        place = np.where((self.bytes[place] != 0) & (self.bytes[other] == 0), other, place)
        _, one = np.unique(place, return_index=True)  # of parts with one place, one stays
        fit, w, place = fit[one], w[one], place[one]
        for mine, key in zip(self.keys, keys):
            mine[place] = key[w]
        self.bytes[place] = width[w]
        self.size[place], self.ids[place] = lengths[fit], kept[fit]


def text_blocks(texts: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of the texts of an Arrow array: the first, the one after the last, their bytes
    and where each text begins (and the last one ends).  Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(at, at[first] + block, side="right")) - 1)
        yield first, stop, raw[at[first] : at[stop]], at[first : stop + 1] - at[first]
        first = stop
