"""Byte views of text columns inside Arrow batches, and vectorised hashing of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text that one numpy pass works on; longer texts are passed in slices.
BLOCK = 1 << 19


#: Rows of an Arrow batch at most. Whole texts are large, and executors hold a batch on both sides.
BATCH_ROWS = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` in a session whose Arrow batches have at most ``BATCH_ROWS`` rows (it stays so)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes of text that an operator works on at a time where its results are larger than the text.
SLICE_BYTES = 8 << 20


def byte_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of a string column; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def ascii_lower() -> np.ndarray:
    """A table that lowers A-Z and keeps every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = ascii_lower()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spread_table(size: int, seed: int, dtype=np.uint64) -> np.ndarray:
    """``size`` well-spread words made by a rule, the same on every machine."""
    words = mix64(np.arange(1, size + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(32)))
    return (words >> np.uint64(64 - np.dtype(dtype).itemsize * 8)).astype(dtype)
