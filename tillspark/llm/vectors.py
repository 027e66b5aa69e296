"""Columns of vectors as numpy matrices, and fixed-width integer vectors as binary columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors are there with finite entries only, their lengths, and their entries as doubles."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    whole = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    return whole, lengths[whole], entries[np.repeat(whole, lengths)]


def whole_numbers(entries: np.ndarray, scale: int, shift: int, largest: int) -> np.ndarray:
    """floor(scale * entry) + shift as 32-bit integers, held within ``largest``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(entries * scale) + shift
    return np.clip(scaled, -largest, largest).astype(np.int32)


def binary_rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary value per vector, from the concatenated 32-bit entries of all."""
    offsets = np.concatenate([[0], np.cumsum(lengths * values.itemsize)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def flat_values(column: pa.Array) -> np.ndarray:
    """All 32-bit entries of a binary column without nulls, one after the other."""
    _, where, data = column.buffers()
    if len(column) == 0:  # may come without any offset
        return np.empty(0, np.int32)
    offsets = np.frombuffer(where, np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.empty(0, np.int32)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.int32)


def padded_matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row per binary value, shorter vectors filled up with zeros."""
    values = flat_values(column)
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out
