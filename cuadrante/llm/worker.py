"""Memory of Python workers, which live through all stages of an application."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

from cuadrante.llm.word_table import WordTable

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library


def give_back(tables: bool = True) -> None:
    """Hand memory that nothing uses back to the system, that of word tables as well
    unless ``tables`` is false.  Tables are made again where they are needed."""
    if tables:
        WordTable.made.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tables: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which begins without what earlier stages left in its worker and leaves
    nothing of its own.  With ``tables`` false the word tables stay."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(tables)
        try:
            yield from run(batches)
        finally:
            give_back(tables)

    return task
