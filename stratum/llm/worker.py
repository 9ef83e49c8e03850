"""Memory of Python workers.

Spark keeps a Python worker from task to task and from stage to stage, and with
it whatever the code remembers (word tables, encoders) and whatever the
allocators keep of freed memory. ``task`` wraps what ``mapInArrow`` runs: when a
worker is handed to another operator, what the last one remembered is dropped,
and at the end of each task freed memory goes back to the system. So a worker
holds one operator's tables at a time, however many stages an application has.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_forget: list[Callable[[], None]] = []
_owner: str | None = None


def remembers(forget: Callable[[], None]) -> None:
    """Register how a module drops what it remembers between tasks."""
    _forget.append(forget)


def _claim(owner: str) -> None:
    global _owner
    if _owner not in (None, owner):
        for forget in _forget:
            forget()
    _owner = owner


def trim() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library that has it
        pass


def task(owner: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task of the operator ``owner``."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim(owner)
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped
