"""Arrow batches of texts inside tasks: bounded slices, and helpers on their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of one slice, in bytes. A single longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.LargeStringArray:
    """The text column with empty strings for nulls."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, with at most ``limit`` bytes of text in each slice."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def bytes_and_offsets(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each text starts and ends."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i]`` for every i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser for hash values, element by element."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
