"""Columns of vectors as matrices, and as short byte strings that are equal exactly if the vectors are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTHS = ("<i2", "<i4", "<i8")  # integers are stored in the narrowest kind that holds the whole vector
LIMITS = [np.iinfo(w).max for w in WIDTHS]


def usable(column: pa.Array) -> np.ndarray:
    """Which lists of a column of lists of doubles are not null and hold only finite numbers."""
    column = pa.concat_arrays([column])
    known = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten()
    odd = ~pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    owner = np.searchsorted(ends, np.flatnonzero(odd), side="right")
    known = known.copy()
    known[owner] = False
    return known


def matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """One row per list of a column without nulls, filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), size.max(initial=0) if dim is None else dim))
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _trimmed(rows: np.ndarray) -> np.ndarray:
    """How many columns of each row are left without the zeros at its end."""
    return np.where(rows != 0, np.arange(1, rows.shape[1] + 1), 0).max(1, initial=0)


def _packed(rows: np.ndarray, mark: np.ndarray, kinds) -> pa.Array:
    """The rows without zeros at the end, as bytes of the kind that their mark names; the first byte is the mark."""
    size = _trimmed(rows)
    out = np.empty(len(rows), object)
    both = size * len(kinds) + mark
    for key in np.unique(both).tolist():
        at = np.flatnonzero(both == key)
        kind, n = kinds[key % len(kinds)], key // len(kinds)
        data = np.ascontiguousarray(rows[at, :n].astype(kind)).view(np.uint8).reshape(len(at), -1)
        data = np.column_stack([np.full(len(at), key % len(kinds), np.uint8), data])
        joined, step = data.tobytes(), data.shape[1]
        out[at] = [joined[i : i + step] for i in range(0, len(joined), step)]
    return pa.array(out, pa.binary())


def _unpacked(column: pa.Array, dim: int, kinds, dtype) -> np.ndarray:
    column = pa.concat_arrays([column])
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    out = np.zeros((len(column), dim), dtype)
    size = np.diff(ends)
    mark = data[ends[:-1]].astype(np.int64) if len(column) else size
    both = size * len(kinds) + mark
    for key in np.unique(both).tolist():
        at = np.flatnonzero(both == key)
        kind, n = kinds[key % len(kinds)], key // len(kinds) - 1
        if n:
            rows = data[ends[at][:, None] + 1 + np.arange(n)]
            out[at, : n // np.dtype(kind).itemsize] = np.ascontiguousarray(rows).view(kind)
    return out


def pack_integers(rows: np.ndarray) -> pa.Array:
    largest = np.maximum(rows.max(1, initial=0), -(rows.min(1, initial=0) + 1))
    return _packed(rows, np.searchsorted(LIMITS, largest), WIDTHS)


def unpack_integers(column: pa.Array, dim: int) -> np.ndarray:
    return _unpacked(column, dim, WIDTHS, np.int64)


FLOATS = ("<f4", "<f8")


def pack_floats(rows: np.ndarray) -> pa.Array:
    """Doubles; in four bytes each where that loses nothing.  -0.0 counts as 0.0."""
    rows = rows + 0.0
    with np.errstate(over="ignore"):
        short = (rows.astype("<f4").astype(np.float64) == rows).all(1)
    return _packed(rows, np.where(short, 0, 1), FLOATS)


def unpack_floats(column: pa.Array, dim: int) -> np.ndarray:
    return _unpacked(column, dim, FLOATS, np.float64)
