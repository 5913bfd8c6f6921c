"""Vectors of an Arrow list column on an integer grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Grid values lie below this, so that sums of their products are exact in a double.
LARGEST = 1 << 22


def on_grid(column: pa.Array, scale: float, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector, and ``floor(scale * x)`` of those, a row each.

    A NULL or empty list, and one with a NULL, infinite or undefined component, holds none. All
    others must have one length (``width``, if given) and stay below ``LARGEST``: ValueError.
    """
    lengths = np.asarray(pc.list_value_length(column).fill_null(0), dtype=np.int64)
    values = pc.list_flatten(column).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    whole = (lengths > 0) & (faults[edges[1:]] == faults[edges[:-1]])
    widths = np.unique(lengths[whole])
    if len(widths) > 1 or (width is not None and len(widths) and widths[0] != width):
        raise ValueError(f"vectors of one length are needed, not of {widths.tolist()} and {width}")
    grid = np.floor(scale * values[np.repeat(whole, lengths)])
    if len(grid) and np.abs(grid).max() >= LARGEST:
        raise ValueError(f"scaled components must lie below {LARGEST}")
    return whole, grid.astype(np.int64).reshape(int(whole.sum()), -1 if len(widths) else 0)


def as_lists(matrix: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    edges = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(matrix.ravel()).cast(kind))


def as_matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column whose lists have one length, as a matrix of 64-bit integers."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), -1 if len(column) else 0)
