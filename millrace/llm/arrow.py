"""Small helpers for passes over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(batch: pa.RecordBatch, column: str, at_most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch as consecutive parts of about ``at_most`` bytes in ``column``; one longer value is a part of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // at_most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def utf8(column: pa.Array) -> pa.Array:
    """The texts with null as the empty text, in an array of their own: kernels misread the offsets of a slice."""
    return pc.fill_null(column.take(pa.array(range(len(column)), pa.int64())).cast(pa.large_string()), "")


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as none."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
