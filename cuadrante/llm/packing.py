"""Best-fit packing of tokenised documents by bin completion.

Pieces differ, for packing, only by their length, which the capacity bounds.  So the
search runs on how many pieces there are of each length: a node takes the longest
length left, lists the undominated fillings of the rest of its sequence and uses one
of them for as many sequences as the counts allow.  What a search holds is bounded by
the capacity, whatever the corpus; the pieces themselves are sorted and assigned by
Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadrante.llm.word_table import BLOCK, PLACES, WordTable, between_spaces, text_blocks
from cuadrante.llm.worker import lean
from cuadrante.operators.ranking import sequential_id
from cuadrante.session import pin

CAPACITY = 4096
END_ID = 1
NODES = 30_000  # of the search; the incumbent at its end is used
FILLINGS = 6  # tried at a node

Pattern = tuple[tuple[int, int], ...]  # (length, copies) of one sequence, longest first


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, places: int = PLACES, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and the ids as little-endian
    unsigned 32-bit numbers) of each piece of ``docs`` (doc_id, text).

    A document's ids end with ``END_ID``; only those longer than ``capacity`` are cut.
    Null text counts as empty and is one piece of length 1.  Rows that repeat an id give
    pieces of their own; other columns are left out; an empty table gives no rows.
    ``tokenizer`` is the path of a tokenizer file that every executor has; it must drop
    blanks and line feeds and never join what stands on their two sides.  ``places`` of the
    word table and ``block``, the bytes of texts cut at once, bound what a worker holds;
    the pieces do not depend on them.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema, end = pa.schema(fields), np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable.of(tokenizer, between_spaces, fold=True, places=places)
        for batch in batches:
            for first, stop, data, offsets in text_blocks(batch.column(1), block):
                rows: list[tuple] = []
                coded, ends = table.encode(data, offsets)
                coded, ends = coded.astype("<u4").tobytes(), (4 * ends).tolist()
                for i, a, b in zip(batch.column(0).slice(first, stop - first).to_pylist(), ends[:-1], ends[1:]):
                    ids = coded[a:b] + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((i, k, at // 4, len(own) // 4, zlib.crc32(own)) + ((own,) if with_ids else ()))
                columns = list(zip(*rows)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run, tables=False), ddl)


def fillings(counts: np.ndarray, room: int) -> list[list[int]]:
    """Undominated fillings of ``room`` with lengths that are left, least waste first.

    A single length that fills the room dominates every other filling.  Else the largest
    single one does so for all fillings with no larger sum, and for each other first
    length the largest second one does for all smaller.  Threes are tried where no two
    fill the room, and what is left after three is filled greedily.
    """
    if room <= 0:
        return [[]]
    if counts[room]:
        return [[room]]
    have = np.flatnonzero(counts[: room + 1])
    if not len(have):
        return [[]]
    largest = np.zeros(room + 1, np.int64)  # the largest length left up to each size
    largest[have] = have
    np.maximum.accumulate(largest, out=largest)
    first = have[::-1]
    second = np.minimum(largest[room - first], first)
    second = np.where((second == first) & (counts[first] < 2), np.where(first > 0, largest[np.maximum(first - 1, 0)], 0), second)
    second = np.where(first + second <= room, second, 0)
    total = first + second
    third = np.minimum(largest[room - total], np.where(second > 0, second, 0))
    need = 1 + (third == second).astype(int) + (third == first)
    third = np.where((third > 0) & (counts[third] >= need), third, 0)
    total = total + third
    order = np.lexsort((-first, -total))
    found, seen = [], set()
    for j in order[: 4 * FILLINGS]:
        one = [int(v) for v in (first[j], second[j], third[j]) if v]
        left = room - sum(one)
        while left > 0 and largest[left]:  # greedy, with what is not yet used up
            v = int(largest[left])
            if counts[v] - one.count(v) <= 0:
                smaller = [int(x) for x in have[have < v][::-1][:8] if counts[x] > one.count(int(x))]
                if not smaller:
                    break
                v = smaller[0]
            one.append(v)
            left -= v
        key = tuple(sorted(one, reverse=True))
        if key not in seen:
            seen.add(key)
            found.append(list(key))
        if left == 0 or len(found) == FILLINGS:
            break
    found.sort(key=lambda f: (room - sum(f), len(f)))
    if found and sum(found[0]) == room:
        return found[:1] + found[1:FILLINGS]
    return found


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: patterns and how many sequences use each."""
    opened: dict[int, list[tuple[Pattern, int]]] = {}  # by room left
    rooms: list[int] = []
    from bisect import bisect_left, insort

    def put(pattern: Pattern, n: int, room: int) -> None:
        if room not in opened:
            opened[room] = []
            insort(rooms, room)
        opened[room].append((pattern, n))

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left >= each:
                    put(((size, each),), left // each, capacity - each * size)
                    left %= each
                else:
                    put(((size, left),), 1, capacity - left * size)
                    left = 0
                continue
            room = rooms[at]
            pattern, n = opened[room].pop()
            if not opened[room]:
                del opened[room]
                rooms.pop(at)
            each = min(room // size, left)
            use = min(n, left // each)
            if use < n:
                put(pattern, n - use, room)
            put(pattern + ((size, each),), use, room - each * size)
            left -= use * each
    return [(p, n) for groups in opened.values() for p, n in groups]


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Patterns that use up ``counts`` (by length, 0 to ``capacity``) in few sequences.

    Depth-first branch and bound.  The incumbent is the best-fit packing at first; a
    branch is cut when its waste alone would make it no better, and the search ends when
    the sum of lengths allows no fewer sequences, or after ``nodes`` nodes.
    """
    counts = counts.astype(np.int64).copy()
    total = int(counts @ np.arange(len(counts)))
    if not total:
        return []
    least = -(-total // capacity)
    incumbent = best_fit(counts, capacity)
    bins = sum(n for _, n in incumbent)
    stack: list[list] = []  # [fillings still to try, pattern in use, sequences, waste]
    used, wasted, seen = 0, 0, 0
    top = capacity
    while bins > least and seen < nodes:
        seen += 1
        while top and not counts[top]:
            top -= 1
        forward = True
        if not top:
            if used < bins:
                bins, incumbent = used, [(p, n) for _, p, n, _, _ in stack]
            forward = False
        elif wasted > (bins - 1) * capacity - total:
            forward = False
        if forward:
            counts[top] -= 1
            options = [(top, f) for f in fillings(counts, capacity - top)]
            counts[top] += 1
            stack.append([options, None, 0, 0, top])
        # Take the next filling, backing up over nodes that have none left.
        while stack:
            options, pattern, n, waste, size = stack[-1]
            if pattern is not None:
                for v, k in pattern:
                    counts[v] += k * n
                used -= n
                wasted -= waste
            if options:
                head, rest = options.pop(0)
                sizes, copies = np.unique([head, *rest], return_counts=True)
                pattern = tuple((int(v), int(k)) for v, k in zip(sizes[::-1], copies[::-1]))
                n = min(int(counts[v]) // k for v, k in pattern)
                waste = n * (capacity - head - sum(rest))
                for v, k in pattern:
                    counts[v] -= k * n
                used += n
                wasted += waste
                stack[-1][1:4] = pattern, n, waste
                top = size
                break
            stack.pop()
        if not stack:
            break
    return incumbent


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``) and each one's ``sequence_id`` and
    ``offset``, gapless from 0.

    Pieces are numbered in the order of their lengths, so each slot of the plan covers a
    run of numbers; the table of runs is bounded by the search, not by the pieces.
    """
    pieces = pin(pieces)
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row per length up to the capacity
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["n"]
    first = np.concatenate([[0], np.cumsum(counts)])  # the first number of each length
    taken = np.zeros(capacity + 1, np.int64)
    runs, sequence = [], 0
    for pattern, n in complete_bins(counts, capacity, nodes):
        offset = 0
        for size, k in pattern:
            runs.append((first[size] + taken[size], sequence, k, size, offset))
            taken[size] += k * n
            offset += size * k
        sequence += n
    if (taken != counts).any():
        raise AssertionError("the plan does not use every piece once")
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    sent = pieces.sparkSession.sparkContext.broadcast(table)
    numbered = sequential_id(pieces, ["length", "doc_id", "piece", "start"], start=0, name="_number")
    schema = numbered.drop("_number").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", sequence_id long, offset long"
    names = [*schema.names, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, seq, copies, size, offset = sent.value.T
        for batch in batches:
            number = batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(start, number, side="right") - 1
            place = number - start[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq[at] + place // copies[at]), pa.array(offset[at] + place % copies[at] * size[at])], names=names)

    return numbered.select(*schema.names, "_number").mapInArrow(run, ddl)
