"""Ratios computed in double after exact decimal sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_ratio(numerator, denominator) -> Column:
    """numerator / denominator in double; 0.0 when the denominator is 0 or NULL."""
    n, d = to_double(numerator), to_double(denominator)
    return F.when(F.coalesce(d, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(n / d)
