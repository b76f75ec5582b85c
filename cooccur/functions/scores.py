"""Column expressions for association scores and reproducible pseudo-randomness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def _observed_over_expected(observed: Column, row: Column, col: Column, total: Column) -> Column:
    ratio = observed * total / (row * col)
    return F.when(observed > 0, observed * F.log(ratio)).otherwise(F.lit(0.0))


def llr(k11: Column, ca: Column, cb: Column, n: Column) -> Column:
    """Dunning's G² of the 2x2 table of two items, rounded.

    ``ca``/``cb`` are the users of either item, ``k11`` the users of both and ``n``
    all users. Each cell enters as observed*ln(observed/expected): the textbook
    entropy form subtracts terms of size n*ln(n) and would lose the rounded digits
    once ``n`` reaches hundreds of millions.
    """
    k11, ca, cb, n = (c.cast("double") for c in (k11, ca, cb, n))
    not_a, not_b = n - ca, n - cb
    g2 = (
        _observed_over_expected(k11, ca, cb, n)
        + _observed_over_expected(cb - k11, not_a, cb, n)
        + _observed_over_expected(ca - k11, ca, not_b, n)
        + _observed_over_expected(n - ca - cb + k11, not_a, not_b, n)
    ) * 2
    return F.round(F.greatest(F.lit(0.0), g2), SCORE_DIGITS)


def hash_order(*parts: Column | str) -> Column:
    """Hex digest of the parts joined by ``|``; sorting by it is a fixed shuffle."""
    columns = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.md5(F.concat_ws("|", *columns).cast("binary"))


def unit_random(seed: int, *parts: Column | str) -> Column:
    """A reproducible number in [0, 1) per distinct ``parts``."""
    digits = F.substring(hash_order(F.lit(str(seed)), *parts), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))
