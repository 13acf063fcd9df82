"""Text cleaning used by the staging operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def uppered(name: str) -> Column:
    return F.upper(trimmed(name))


def spaced(name: str) -> Column:
    """``snake_Case`` to ``snake case``: underscores become blanks, then trim and lower."""
    return F.lower(F.trim(F.replace(F.col(name), F.lit("_"), F.lit(" "))))


def underscored(name: str) -> Column:
    """``Paid Ads`` to ``paid_ads``: blanks become underscores, then trim and lower."""
    return F.lower(F.trim(F.replace(F.col(name), F.lit(" "), F.lit("_"))))
