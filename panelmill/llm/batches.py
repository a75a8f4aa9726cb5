"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES, length=pc.binary_length
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice have about ``limit`` bytes (its lists so many values), or are one text."""
    for batch in batches:
        size = pc.fill_null(length(batch.column(column)), 0)
        size = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        for end in [*(np.flatnonzero(np.diff(size // limit)) + 1), len(batch)]:
            if end > begin:
                yield batch.slice(begin, int(end) - begin)
            begin = int(end)


def arrow_bytes(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def lists(flat: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A list array of int from all values and where each list begins (and the end)."""
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(flat.astype(np.int32)))
