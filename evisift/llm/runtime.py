"""What the operators of this subpackage share: scratch tables, free column names, lean workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.scratch import Scratch, shared_dir

__all__ = ["Scratch", "give_back", "lean", "shared_dir", "unused"]


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Hands memory that this process has freed, but its allocators still hold, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to trim by hand
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function whose worker, which serves later tasks and stages too, keeps no freed memory after it."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
