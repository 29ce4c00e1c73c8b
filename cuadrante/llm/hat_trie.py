"""Counts of phrases in a HAT-trie over word ids, and sorted runs of them.

Words have 64-bit ids.  The upper levels of the trie branch by digits of the ids of a
phrase's first two words in turn; below them stand hash containers, which burst into a
node with containers of their own when they grow too large.  When the whole trie grows
too large, its largest subtree leaves as a sorted run for each prefix partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from cuadrante.llm.words import mix

WORD_BITS = 21  # of a word's number in a task; three numbers make a key
MAX_WORDS = 1 << WORD_BITS
PHRASES = MAX_WORDS // 4  # counted at once: their words always have numbers
BURST = 1 << 15  # entries of a container
HELD = 3 << 19  # entries of a trie, some 60 MB
DIGITS = 4  # levels of the trie, of four bits each
LEVEL = 1  # of zstandard, for runs
_LOW = np.uint64(MAX_WORDS - 1)
_STEP = np.uint64(WORD_BITS)


class Slots:
    """Distinct 64-bit keys in an open-addressing table, numbered as they come."""

    def __init__(self, room: int = 64):
        self.table = np.full(room, -1, np.int32)
        self.keys = np.empty(room // 2, np.uint64)
        self.n = 0

    def _grow(self, more: int) -> None:
        room = len(self.table)
        while self.n + more > room // 2:
            room *= 2
        if room > len(self.table):
            keys = self.keys[: self.n]
            self.table, self.keys, self.n = np.full(room, -1, np.int32), np.empty(room // 2, np.uint64), 0
            self.numbers(keys)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each of ``keys``, which are distinct; new ones are added in order."""
        self._grow(len(keys))
        mask = np.uint64(len(self.table) - 1)
        out = np.empty(len(keys), np.int64)
        todo, place = np.arange(len(keys)), (mix(keys) & mask).astype(np.int64)
        fresh = np.zeros(len(keys), bool)
        while len(todo):
            at = self.table[place]
            free = at == -1
            if free.any():  # of the keys that meet in a free place one takes it, with a mark below -1
                own = -2 - todo[free]
                self.table[place[free]] = own
                won = free.copy()
                won[free] = self.table[place[free]] == own
                fresh[todo[won]] = True
                out[todo[won]] = place[won]
                todo, place, at = todo[~won], place[~won], self.table[place[~won]]
            taken = at >= 0
            same = np.zeros(len(at), bool)
            same[taken] = self.keys[at[taken]] == keys[todo[taken]]
            out[todo[same]] = at[same]
            todo, place = todo[~same], (place[~same] + 1) & int(mask)
        new = np.flatnonzero(fresh)
        own = np.arange(self.n, self.n + len(new))
        self.table[out[new]] = own
        self.keys[own] = keys[new]
        out[new] = own
        self.n += len(new)
        return out


class Container:
    """Counts by key."""

    def __init__(self) -> None:
        self.slots, self.counts = Slots(), np.zeros(64, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        at = self.slots.numbers(keys)
        if self.slots.n > len(self.counts):
            grown = np.zeros(max(self.slots.n, 2 * len(self.counts)), np.int64)
            grown[: len(self.counts)] = self.counts
            self.counts = grown
        self.counts[at] += counts

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        return self.slots.keys[: self.slots.n], self.counts[: self.slots.n]


def digits_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sixteen bits: four of the first word's id, four of the second's, and again."""
    a, b = (first >> np.uint64(56)).astype(np.uint16), (second >> np.uint64(56)).astype(np.uint16)
    return (a & 0xF0) << 8 | (b & 0xF0) << 4 | (a & 0x0F) << 4 | (b & 0x0F)


class HatTrie:
    """Counts of phrases of ``length`` words."""

    def __init__(self, length: int, part_bits: int, burst: int = BURST, held: int = HELD):
        self.length, self.part_bits, self.burst, self.held = length, part_bits, burst, held
        self._clear()

    def _clear(self) -> None:
        self.words = Slots(1 << 12)
        self.root: list = [Container() for _ in range(16)]
        self.sizes = np.zeros(16, np.int64)

    def _digits(self, keys: np.ndarray) -> np.ndarray:
        shift = np.uint64(WORD_BITS * (self.length - 1))
        first, second = keys >> shift, (keys >> (shift - _STEP)) & _LOW
        return digits_of(self.words.keys[first.astype(np.int64)], self.words.keys[second.astype(np.int64)])

    def add(self, ids: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Count the phrases that begin at the places ``at`` of the words ``ids``; gives what
        has to leave for it.  At most ``PHRASES`` at once."""
        used = np.zeros(len(ids), bool)
        for k in range(self.length):
            used[at + k] = True
        own, inverse = np.unique(ids[used], return_inverse=True)
        if self.words.n + len(own) > MAX_WORDS:
            yield from self.spill_all()
        number = np.zeros(len(ids), np.uint64)
        number[used] = self.words.numbers(own)[inverse]
        key = number[at]
        for k in range(1, self.length):
            key = key << _STEP | number[at + k]
        key.sort()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        counts = np.diff(np.append(edge, len(key)))
        key = key[edge]
        digits = self._digits(key)
        order = np.argsort(digits, kind="stable")
        self._insert(self.root, key[order], counts[order], digits[order], 0)
        while self.sizes.sum() > self.held:
            yield from self.spill(int(self.sizes.argmax()))

    def _insert(self, node: list, keys: np.ndarray, counts: np.ndarray, digits: np.ndarray, level: int) -> None:
        digit = (digits >> np.uint16(12 - 4 * level)) & np.uint16(15)
        cuts = np.searchsorted(digit, np.arange(17))
        for d in range(16):
            a, b = int(cuts[d]), int(cuts[d + 1])
            if a == b:
                continue
            child = node[d]
            if isinstance(child, list):
                self._insert(child, keys[a:b], counts[a:b], digits[a:b], level + 1)
            else:
                child.add(keys[a:b], counts[a:b])
                if child.slots.n > self.burst and level + 1 < DIGITS:
                    own, n = child.entries()
                    place = self._digits(own)
                    order = np.argsort(place, kind="stable")
                    node[d] = [Container() for _ in range(16)]
                    self._insert(node[d], own[order], n[order], place[order], level + 1)
            if level == 0:
                self.sizes[d] = sum(c.slots.n for c in self._containers(node[d]))

    def _containers(self, node) -> Iterator[Container]:
        if isinstance(node, list):
            for child in node:
                yield from self._containers(child)
        else:
            yield node

    def spill(self, digit: int) -> Iterator[tuple[int, bytes]]:
        """The subtree of a first digit leaves: a sorted run for each prefix partition."""
        entries = [c.entries() for c in self._containers(self.root[digit])]
        keys, counts = (np.concatenate([e[k] for e in entries]) for k in (0, 1))
        self.root[digit], self.sizes[digit] = Container(), 0
        columns = [self.words.keys[((keys >> np.uint64(WORD_BITS * k)) & _LOW).astype(np.int64)] for k in reversed(range(self.length))]
        part = digits_of(columns[0], columns[1]) >> np.uint16(16 - self.part_bits)
        order = np.lexsort((*reversed(columns), part))
        part, counts, columns = part[order], counts[order], [c[order] for c in columns]
        edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        for a, b in zip(edge, [*edge[1:], len(part)]):
            yield int(part[a]), packed_run([c[a:b] for c in columns], counts[a:b])

    def spill_all(self) -> Iterator[tuple[int, bytes]]:
        for digit in range(16):
            yield from self.spill(digit)
        self._clear()


def packed_run(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Phrases and their counts: the distinct word ids, each word's place among them, in
    byte planes, and the counts."""
    from zstandard import ZstdCompressor

    words, at = np.unique(np.concatenate(columns), return_inverse=True)
    planes = np.ascontiguousarray(np.concatenate([at.astype("<u4"), counts.astype("<u8").view("<u4")]).view(np.uint8).reshape(-1, 4).T)
    head = np.array([len(columns), len(counts), len(words)], "<i8")
    return ZstdCompressor(level=LEVEL).compress(b"".join([head.tobytes(), words.astype("<u8").tobytes(), planes.tobytes()]))


def unpacked_run(raw: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    from zstandard import ZstdDecompressor

    raw = ZstdDecompressor().decompress(raw)
    length, n, n_words = np.frombuffer(raw, "<i8", 3).tolist()
    words = np.frombuffer(raw, "<u8", n_words, 24)
    planes = np.frombuffer(raw, np.uint8, offset=24 + 8 * n_words).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel()
    at = flat[: length * n].reshape(length, n)
    return [words[a] for a in at], flat[length * n :].copy().view("<u8").astype(np.int64)


def merged(runs: list[bytes], least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sums of sorted runs, without phrases below ``least``."""
    parts = [unpacked_run(r) for r in runs]
    counts = np.concatenate([n for _, n in parts])
    columns = [np.concatenate(c) for c in zip(*(c for c, _ in parts))]
    words = np.unique(np.concatenate(columns))
    if len(words) <= MAX_WORDS:  # the usual case: one key for a phrase
        key = np.zeros(len(counts), np.uint64)
        for c in columns:
            key = key << _STEP | np.searchsorted(words, c).astype(np.uint64)
        order = np.argsort(key, kind="stable")  # which merges runs that are in order
        key = key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort(columns[::-1])
        first = np.zeros(len(counts), bool)
        first[0] = True
        for c in columns:
            first[1:] |= c[order][1:] != c[order][:-1]
    at = np.flatnonzero(first)
    sums = np.add.reduceat(counts[order], at)
    keep = sums >= least
    return [c[order][at][keep] for c in columns], sums[keep]
