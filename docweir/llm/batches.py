"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into Python strings together.
LIMIT = 8 << 20


def bounded(batches: Iterable[pa.RecordBatch], limit: int = LIMIT, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into parts whose texts hold ``limit`` bytes at most, or one text more than fits.

    Lengths come from the Arrow offsets, so nothing becomes a Python object before the
    cut: memory is bounded by ``limit`` and the longest text, not by the rows of a batch.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)
