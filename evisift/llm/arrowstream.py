"""Whole groups out of Arrow batches that arrive sorted by key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, and where each group begins (with the end); only the last group waits for more."""
    held: list[pa.RecordBatch] = []

    def starts(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, bool)
        change[:1] = True
        for k in keys:
            v = t.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(change)

    for x in batches:
        if not x.num_rows:
            continue
        t = pa.Table.from_batches([*held, x]).combine_chunks()
        at = starts(t)
        if len(at) > 1:
            yield t.slice(0, at[-1]), at
            t = t.slice(at[-1])
        held = t.to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, np.array([0, t.num_rows])


def blobs(t: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a binary column end to end, and the number of entries of each row."""
    parts = [np.frombuffer(v, kind) for v in t.column(name).to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.array([len(p) for p in parts], np.int64)
