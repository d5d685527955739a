"""Linear recurrences over packed arrays, chunk by chunk in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries of a chunk; a sequence of T entries takes about chunk + T / chunk vector operations.
CHUNK = 256


def reverse_scan_flat(x: np.ndarray, offsets: np.ndarray, decay: float, chunk: int = CHUNK) -> np.ndarray:
    """y_t = x_t + decay * y_{t+1} inside each sequence ``offsets[i]:offsets[i + 1]``.

    Chunks, counted from the end of each sequence, are scanned all at once; then each takes over the state of the chunk after it.
    """
    y = np.array(x, dtype=np.float64)
    start, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    parts = -((start - end) // chunk)
    if not len(parts) or not parts.sum():
        return y
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)  # 0 is the last chunk of its sequence
    last = np.repeat(end, parts) - number * chunk
    first = np.maximum(last - chunk, np.repeat(start, parts))
    for k in range(1, min(chunk, int((last - first).max()))):
        at = (last - 1 - k)[last - first > k]
        y[at] += decay * y[at + 1]
    power = decay ** np.arange(1, chunk + 1, dtype=np.float64)
    order = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[order], np.arange(int(parts.max()) + 1))
    for n in range(1, int(parts.max())):
        own = order[bounds[n] : bounds[n + 1]]
        size = last[own] - first[own]
        back = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)  # distance from the chunk's end
        y[np.repeat(last[own] - 1, size) - back] += np.repeat(y[last[own]], size) * power[back]
    return y


@lru_cache(maxsize=64)
def _udf(decay: float, chunk: int):
    @F.arrow_udf("array<double>")
    def scan(a: pa.Array) -> pa.Array:
        offsets = a.offsets.to_numpy().astype(np.int64)
        x = a.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out = reverse_scan_flat(x[offsets[0] : offsets[-1]], offsets - offsets[0], decay, chunk)
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(out, from_pandas=True), mask=a.is_null() if a.null_count else None)

    return scan


def reverse_scan(x: Column, decay: float, chunk: int = CHUNK) -> Column:
    """The recurrence for a column of arrays; an empty array stays empty, a null one null."""
    return _udf(float(decay), int(chunk))(x)
