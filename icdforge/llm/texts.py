"""Arrow string columns as byte slices (used by the Python operators)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def byte_slices(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string column: value i is data[offsets[i]:offsets[i+1]],
    without copies; a null value is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        size = np.where(np.asarray(column.is_valid()), np.diff(o), 0)
        if (size != np.diff(o)).any():  # null slots may span bytes
            parts = [buf[o[i]:o[i] + size[i]] for i in range(n)]
            return np.concatenate(parts) if parts else buf, np.concatenate([[0], np.cumsum(size)])
    return buf, o


def spans(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive values of at most ``limit`` bytes (one value at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
