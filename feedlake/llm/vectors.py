"""Vectors of embedding columns as numpy arrays and back."""

import numpy as np
import pyarrow as pa


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """Per row the vector in double precision; None if it is null, empty, or holds nulls,
    infinities or NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    starts, values = column.offsets.to_numpy(), column.values
    numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(numbers))))
    present = column.is_valid().to_numpy(zero_copy_only=False)
    rows = []
    for i, there in enumerate(present.tolist()):
        first, end = starts[i], starts[i + 1]
        sound = there and end > first and bad[first] == bad[end]
        rows.append(numbers[first:end] if sound else None)
    return rows


def floored(column: pa.Array, factor: int) -> tuple[list[int], list[bytes | None]]:
    """Per row its length and floor(factor * x) of its components as bytes: 4 for each where
    all of them fit, else doubles. 0 and None for rows that `rows_of` leaves out. A component
    too large for a double once it is scaled raises an error."""
    lengths, data = [], []
    for row in rows_of(column):
        if row is None:
            lengths.append(0)
            data.append(None)
            continue
        with np.errstate(over="ignore"):
            whole = np.floor(factor * row)
        if not np.isfinite(whole).all():
            raise ValueError("a component is too large to be scaled")
        small = np.abs(whole).max() < 1 << 31
        lengths.append(len(row))
        data.append(whole.astype("<i4" if small else "<f8").tobytes())
    return lengths, data


def matrix(vectors, length: int) -> np.ndarray:
    """Rows of whole numbers, as `floored` gives them, in doubles."""
    rows = np.empty((len(vectors), length))
    for i, data in enumerate(vectors):
        rows[i] = np.frombuffer(data, "<i4" if len(data) == 4 * length else "<f8")
    return rows


def integers(vectors: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers, which are of any size."""
    return np.array([[int(x) for x in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)
