"""Giving memory back between tasks: Python workers are used again, by other operators too."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    """Hand what is free back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_KEPT: dict[str, Callable[[], None]] = {}


def keeps(module: str, clear: Callable[[], None]) -> None:
    """Tell that a module keeps something between its tasks, and how to drop it."""
    _KEPT[module] = clear


def drop_others(module: str) -> None:
    """Drop what other modules have kept in this process: its memory is the next operator's now."""
    for name, clear in _KEPT.items():
        if name != module:
            clear()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function over batches, without what other operators have kept, and with ``release`` at the end of the task."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(run.__module__)
        try:
            yield from run(batches)
        finally:
            release()

    return tidied
