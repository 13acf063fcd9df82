"""Rounded ratios that give NULL, not an error, on an empty base."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(top: Column, base: Column, digits: int = 1) -> Column:
    """``top`` in percent of ``base`` in decimal arithmetic."""
    return F.round(F.try_divide(top * F.lit(100.0).cast("decimal(4,1)"), base), digits)
