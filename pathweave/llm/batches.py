"""Arrow batches in pieces of bounded text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES = 8 << 20


def bounded(batches: Iterator[pa.RecordBatch], column: str, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Slices with about ``most`` bytes in ``column`` each; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)
