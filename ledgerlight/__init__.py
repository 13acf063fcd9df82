"""Subscription-revenue and product analytics as Spark DataFrame jobs."""

from ledgerlight.context import RunContext

__all__ = ["RunContext"]
