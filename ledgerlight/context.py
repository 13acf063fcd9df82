"""Run settings shared by every operator.

Nothing in the library asks the clock for business dates: ``as_of`` stands in
for "today", so a run can be repeated and checked.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class RunContext:
    as_of: date
    reporting_start: date = date(2022, 1, 1)
    # Cancellations in [spike_start, spike_end) carry the spike flag.
    spike_start: date = date(2023, 7, 1)
    spike_end: date = date(2023, 12, 31)
    lookback_days: int = 3
    lookback_months: int = 3

    def today(self) -> Column:
        return F.lit(self.as_of)

    def first_month(self) -> Column:
        return F.lit(self.reporting_start.replace(day=1))

    def current_month(self) -> Column:
        return F.lit(self.as_of.replace(day=1))

    def oldest_reloaded_month(self) -> Column:
        """``yyyyMM`` of the oldest month an incremental MRR run rewrites."""
        return F.date_format(F.add_months(self.today(), -self.lookback_months), "yyyyMM")
