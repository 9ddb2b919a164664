"""Cutting Arrow batches into slices of bounded text, so that a worker's memory follows bytes and not rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES, SLICE_ROWS = 1 << 20, 1000


def bounds(column: pa.Array, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """First row and end of each slice; a text longer than most_bytes is a slice of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(column):
        fits = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most_bytes, "right"))
        end = min(max(fits, start + 1), start + most_rows, len(column))
        yield start, end
        start = end


def text_slices(batches: Iterator[pa.RecordBatch], column: int | str, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """All rows of the batches, in slices whose texts (in column) have at most most_bytes together, or are one row."""
    for batch in batches:
        for start, end in bounds(batch.column(column), most_bytes, most_rows):
            yield batch.slice(start, end - start)
