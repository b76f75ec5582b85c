"""Columns of whole numbers as single compressed values, for tables that are written and shuffled in parts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


def packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers as one value: the first bytes of all numbers, the second ones, and so on, compressed."""
    planes = np.stack(columns).astype("<i8").view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(value: pa.Scalar, columns: int) -> np.ndarray:
    """The columns that :func:`packed` made a value of, one below the other."""
    planes = np.frombuffer(zstandard.decompress(value.as_buffer()), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[..., 0]
