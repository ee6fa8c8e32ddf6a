"""Null handling, rounding, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import as_column


def null_to_zero(value: Column | str, dtype: str | None = None) -> Column:
    filled = F.coalesce(as_column(value), F.lit(0))
    return filled.cast(dtype) if dtype else filled


def round_scaled(value: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary value times a power of ten.

    Spark's own ``round`` works on the shortest decimal text of a double (1.005 gives 1.01);
    the results to match round the scaled double (1.00).
    """
    scale = F.lit(10.0**digits)
    return F.round(as_column(value) * scale, 0) / scale


def percentage(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent; null when ``whole`` is zero or null."""
    ratio = as_column(part).cast("double") / F.nullif(as_column(whole), F.lit(0))
    return round_scaled(ratio * F.lit(100), digits)


def mean(total: Column | str, count: Column | str) -> Column:
    """Average rebuilt from a pre-aggregated sum and count."""
    return as_column(total).cast("double") / F.nullif(as_column(count), F.lit(0))
