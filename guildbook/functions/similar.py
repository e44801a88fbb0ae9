"""Fuzzy ratio of two strings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per character of a."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the longest common subsequence over both lengths; 1 for equal strings, 0 if one is empty."""
    return pd.Series([0.0 if not x or not y else 1.0 if x == y else 2.0 * _lcs(x, y) / (len(x) + len(y)) for x, y in zip(a, b, strict=True)], dtype="float64")
