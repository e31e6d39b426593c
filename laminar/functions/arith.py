"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laminar.functions._util import as_col


def safe_divide(a, b) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is zero or NULL; floating result."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def percent(a, b) -> Column:
    """SAFE_DIVIDE(a, b) * 100."""
    return safe_divide(a, b) * F.lit(100)
