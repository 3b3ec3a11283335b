"""Passing Arrow batches through Python functions in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# Rows and bytes of the texts handled together; a longer text is handled alone.
ROWS, BYTES = 512, 8 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` has a bounded total size."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(length.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, min(begin + rows, int(np.searchsorted(ends, base + size, side="right"))))
            yield batch.slice(begin, end - begin)
            begin = end


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts; null is empty."""
    return [x or "" for x in batch.column(column).to_pylist()]
