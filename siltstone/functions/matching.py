"""Join conditions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the columns of two aliased frames, null being equal to null."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns],
        F.lit(True),
    )
