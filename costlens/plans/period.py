"""Reporting period: a calendar month and its bounds."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Period:
    year: int
    month: int

    @property
    def month_start(self) -> dt.date:
        return dt.date(self.year, self.month, 1)

    @property
    def month_end(self) -> dt.date:
        return dt.date(self.year, self.month, calendar.monthrange(self.year, self.month)[1])

    @property
    def cut(self) -> dt.date:
        """Inclusive cut-off date of every 'to date' metric (= month end = period_date)."""
        return self.month_end

    def previous(self) -> "Period":
        prev = self.month_start - dt.timedelta(days=1)
        return Period(prev.year, prev.month)


DEFAULT_PERIOD = Period(1997, 1)
