"""Vector columns as integer matrices, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A scaled component beyond these ends counts as the end, so sums over many rows stay exact.
LIMIT = 1 << 46


def integer_rows(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors of ``column`` and their matrix of ``floor(scale * x)``, a row for each.

    A vector that is null or holds a null, an infinity or a NaN is not usable. Shorter vectors are filled up with zeros
    to the longest of the batch. ``scale * x`` is worked out in doubles.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    usable = there & (np.bincount(row[~np.isfinite(flat)], minlength=len(column)) == 0)
    keep = np.flatnonzero(usable)
    out = np.zeros((len(column), int(lengths[keep].max(initial=0))), np.int64)
    mine = usable[row]
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(flat[mine] * scale), -LIMIT, LIMIT)
    out[row[mine], place[mine]] = scaled.astype(np.int64)
    return keep, out[keep]


def widen(matrix: np.ndarray, width: int) -> np.ndarray:
    """``matrix`` with columns of zeros up to ``width``."""
    return matrix if matrix.shape[1] >= width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))
