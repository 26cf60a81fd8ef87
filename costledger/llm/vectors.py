"""Arrow vectors as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions and values (as double) of the vectors that are not NULL or empty and hold finite numbers only."""
    lists = column.cast(pa.list_(pa.float64()))
    offsets = lists.offsets.to_numpy()
    values = lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    there = np.asarray(lists.is_valid()) & (np.diff(offsets) > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    at = np.flatnonzero(there)
    return at, [values[offsets[i] : offsets[i + 1]] for i in at]


def as_binary(vectors: list[np.ndarray]) -> pa.Array:
    return pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary())


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal length, packed as little-endian doubles, as a matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<f8").reshape(len(rows), -1)
