"""Vector columns as Arrow hands them to a task: flat entries instead of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of every entry of a vector column (sparse and dense rows)."""
    kinds = vectors.field("type").to_numpy(zero_copy_only=False)
    values, indices = vectors.field("values"), vectors.field("indices")
    lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(kinds)), lengths)
    value = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = kinds[row] == 0
    column = place.astype(np.int64)
    column[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, column, value


def offsets(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin, and where the last one's end."""
    return np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
