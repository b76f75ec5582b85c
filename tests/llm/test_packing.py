"""Values of packed columns give the columns back."""

import numpy as np
import pyarrow as pa
import pytest

from cooccur.llm.packing import packed, unpacked


@pytest.mark.parametrize("size", [0, 1, 7, 5000])
@pytest.mark.parametrize("columns", [1, 3])
def test_round_trip(size, columns):
    rng = np.random.default_rng(size)
    whole = [rng.integers(-2**63, 2**63 - 1, size) if i % 2 else rng.integers(-3, 300, size).astype(np.int32) for i in range(columns)]
    value = pa.array([packed(*whole)], pa.binary())[0]
    assert np.array_equal(unpacked(value, columns), np.stack(whole).astype(np.int64))
