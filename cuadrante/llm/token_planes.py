"""Token ids in files of compressed bit or byte planes.

The ids of all documents are one stream, cut into blocks of ``BLOCK_IDS`` ids.  A block is
transposed: its lowest bytes (or bits) stand together, then the next ones, and so on.
Each plane is compressed with zstandard on its own, and planes of zeros take no room.

A file is::

    magic | planes of block 0, 1, ... | document ids | document sizes | block index | tail

The block index has a row per block: its ids, a checksum of them and the compressed size
of each plane, so that a reader can take any run of ids without unpacking other blocks.
The tail has the sizes of what stands before it, the file's place in the stream (part,
file), the number of documents, ids and planes, the magic again and a line feed.

Each file is one value of Spark's text sink, so files appear only when their task has
been committed, in whatever store the sink can write to.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.llm.word_table import WordTable, before_blanks, text_blocks
from cuadrante.session import pin

BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 22  # a file ends with the block of texts that fills it
END_ID = 0
LEVEL = 3
MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<IIIQQqqBB8sc")  # sizes of document ids, sizes and index; documents, ids; part, file; planes, null ids
BYTE_PLANES, BIT_PLANES = 4, 32


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest first; a plane of zeros is empty."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == BIT_PLANES:
        cut = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        cut = rows.T
    return [p.tobytes() if p.any() else b"" for p in cut]


def from_planes(cut: list[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of planes."""
    width = n if len(cut) == BYTE_PLANES else -(-n // 8)
    rows = np.stack([np.frombuffer(p, np.uint8) if p else np.zeros(width, np.uint8) for p in cut])
    if len(cut) == BIT_PLANES:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little"), axis=0, bitorder="little")
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


class PlaneFile:
    """Collects documents and gives the bytes of a file."""

    def __init__(self, part: int, planes: int = BYTE_PLANES, block: int = BLOCK_IDS):
        from zstandard import ZstdCompressor

        self.pack = ZstdCompressor(level=LEVEL).compress
        self.part, self.planes, self.block, self.file = part, planes, block, 0
        self._clear()

    def _clear(self) -> None:
        self.body, self.index, self.waiting, self.docs, self.counts = [MAGIC], [], np.empty(0, "<u4"), [], []
        self.ids = 0

    def add(self, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.counts.append(counts)
        self.ids += len(ids)
        ids = np.concatenate([self.waiting, ids.astype("<u4")])
        whole = len(ids) // self.block * self.block
        for at in range(0, whole, self.block):
            self._block(ids[at : at + self.block])
        self.waiting = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        cut = [self.pack(p) if p else b"" for p in to_planes(ids, self.planes)]
        self.body += cut
        self.index += [len(ids), zlib.crc32(ids.tobytes()), *map(len, cut)]

    def finish(self) -> bytes:
        if len(self.waiting):
            self._block(self.waiting)
        docs = pa.concat_arrays(self.docs)
        none = docs.is_null().to_numpy(zero_copy_only=False)
        doc_ids = docs.fill_null(0).to_numpy().astype("<i8").tobytes() + (np.packbits(none).tobytes() if none.any() else b"")
        parts = [self.pack(doc_ids), self.pack(np.concatenate(self.counts).astype("<i8").tobytes()), self.pack(np.array(self.index, "<u4").tobytes())]
        tail = TAIL.pack(*map(len, parts), len(docs), self.ids, self.part, self.file, self.planes, bool(none.any()), MAGIC, b"\n")
        out = b"".join([*self.body, *parts, tail[:-1]])  # the sink adds the line feed
        self.file += 1
        self._clear()
        return out


class PlaneReader:
    """Reads a file's documents and any run of its ids."""

    def __init__(self, content):
        from zstandard import ZstdDecompressor

        self.unpack = ZstdDecompressor().decompress
        self.raw = memoryview(content)
        *sizes, n, self.n_ids, self.part, self.file, self.planes, none, magic, end = TAIL.unpack(self.raw[-TAIL.size :])
        if magic != MAGIC or bytes(self.raw[: len(MAGIC)]) != MAGIC or end != b"\n":
            raise ValueError("this is not a file of id planes")
        at = len(self.raw) - TAIL.size - sum(sizes)
        parts = []
        for size in sizes:
            parts.append(self.unpack(self.raw[at : at + size]))
            at += size
        self.doc_ids = np.frombuffer(parts[0], "<i8", n)
        self.none = np.unpackbits(np.frombuffer(parts[0], np.uint8, offset=8 * n), count=n).astype(bool) if none else None
        self.counts = np.frombuffer(parts[1], "<i8")
        index = np.frombuffer(parts[2], "<u4").astype(np.int64).reshape(-1, 2 + self.planes)
        self.first = np.concatenate([[0], np.cumsum(index[:, 0])])  # id of each block
        self.checks, self.sizes = index[:, 1], index[:, 2:]
        self.places = len(MAGIC) + np.concatenate([[0], np.cumsum(self.sizes.sum(axis=1))])

    def block(self, k: int) -> np.ndarray:
        at, cut = int(self.places[k]), []
        for size in self.sizes[k].tolist():
            cut.append(self.unpack(self.raw[at : at + size]) if size else b"")
            at += size
        ids = from_planes(cut, int(self.first[k + 1] - self.first[k]))
        if zlib.crc32(ids.tobytes()) != self.checks[k]:
            raise ValueError(f"block {k} does not match its checksum")
        return ids

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the blocks that hold them are unpacked."""
        if start >= stop:
            return np.empty(0, "<u4")
        a, b = int(np.searchsorted(self.first, start, side="right")) - 1, int(np.searchsorted(self.first, stop, side="left"))
        return np.concatenate([self.block(k) for k in range(a, b)])[start - self.first[a] : stop - self.first[a]]

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document in order; a block is unpacked once."""
        k, held = 0, np.empty(0, "<u4")
        for n in self.counts.tolist():
            own = [held[:n]]
            have = len(own[0])
            held = held[n:]
            while have < n:
                held = self.block(k)
                k += 1
                own.append(held[: n - have])
                held = held[n - have :]
                have += len(own[-1])
            yield own[0] if len(own) == 1 else np.concatenate(own)


def _encode(tokenizer: str, end_id: int, planes: int, block_ids: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], names=["value"])

        pa.default_memory_pool().release_unused()  # of earlier stages in this worker
        table = WordTable.of(tokenizer, before_blanks)
        file = PlaneFile(TaskContext.get().partitionId(), planes, block_ids)
        for batch in batches:
            for first, stop, data, offsets in text_blocks(batch.column(1)):
                ids, ends = table.encode(data, offsets)
                ids = np.insert(ids.astype("<u4"), ends[1:], end_id)
                file.add(batch.column(0).slice(first, stop - first), np.diff(ends) + 1, ids)
                if file.ids >= file_ids:
                    yield row()
        if file.docs:
            yield row()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, planes: int = BYTE_PLANES, block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> None:
    """Write the ids of every whole text of ``docs``, each with ``end_id`` behind, in
    ascending order of ``id_col`` to files below ``path``.

    ``tokenizer`` is the path of a byte-level tokenizer file that every executor has.  One
    shuffle sorts the documents into ranges of ids, and a range is encoded and written by
    its task.  Null text counts as empty and has its end id only.  Null ids come first; rows
    that share an id stand next to each other, in the order of their texts' hashes.  Other
    columns are not written; an empty table writes no file with documents.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = ["_id", F.xxhash64("_text"), "_text"]
    placed = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("_id", "_text")
    files = placed.mapInArrow(_encode(tokenizer, end_id, planes, block_ids, file_ids), "value binary")
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _decode(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if not content.as_py():
                    continue  # an empty part of an empty table
                reader = PlaneReader(content.as_buffer())
                n = len(reader.counts)
                starts = np.cumsum(reader.counts) - reader.counts
                checks, ids = np.empty(n, np.int64), []
                for k, own in enumerate(reader.documents()):
                    raw = np.ascontiguousarray(own, "<u4")
                    checks[k] = zlib.crc32(raw)
                    if with_ids:
                        ids.append(raw.tobytes())
                columns = [
                    pa.array(reader.doc_ids, mask=reader.none), pa.array(np.full(n, reader.part)), pa.array(np.full(n, reader.file)),
                    pa.array(starts), pa.array(reader.counts), pa.array(checks),
                ]
                names = ["doc_id", "_part", "_file", "_start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files below ``path``: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned
    32-bit numbers) and, if wanted, the ``ids`` in that form.

    Every block is unpacked and held against its checksum.  Where a file begins follows
    from the sizes of the files before it, summed by part and then by file.
    """
    raw = spark.read.format("binaryFile").load(path).select("content")
    ddl = "doc_id long, _part long, _file long, _start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    read = pin(raw.mapInArrow(_decode(with_ids), ddl))
    files = read.groupBy("_part", "_file").agg(F.sum("n_tokens").alias("_n"))
    parts = files.groupBy("_part").agg(F.sum("_n").alias("_n"))  # a row per task that wrote
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_of_part"))
    own = F.coalesce(F.sum("_n").over(Window.partitionBy("_part").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = pin(files.withColumn("_of_file", own).join(parts, "_part").select("_part", "_file", (F.col("_of_part") + F.col("_of_file")).alias("_base")))
    out = read.join(bounded(bases), ["_part", "_file"]).withColumn("start", F.col("_base") + F.col("_start"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] * with_ids))
