"""Arrow batch helpers for ``mapInArrow`` functions."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def settle() -> None:
    """Give freed memory back to the system: Python workers live on and serve other operators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch in slices of about ``most`` bytes of ``column``; a longer value is a slice of its own."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                yield batch.slice(low, high - low)
        del batch, values
    settle()


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive stretches of ``data`` (ending at item ``ends``) as binary values."""
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = ends * data.itemsize
    kind, offsets = (pa.binary(), offsets.astype(np.int32)) if offsets[-1] < 2**31 else (pa.large_binary(), offsets)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema
    )
