"""Small helpers for functions that run on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, rows: int = 256, characters: int = 1_000_000
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of each batch with at most ``rows`` rows and about ``characters`` bytes of text, or one longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for at, length in enumerate(sizes):
            if at > start and (at - start >= rows or size + length > characters):
                part = batch.slice(start, at - start)
                yield part, part.column(column).to_pylist()
                start, size = at, 0
            size += length
        if start < len(sizes):
            part = batch.slice(start)
            yield part, part.column(column).to_pylist()


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One Arrow list per numpy array."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
