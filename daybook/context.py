"""Period values of one run, all derived from a single run date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class RunContext:
    """Every period a run touches, computed once from the calendar.

    ``run_date`` is the day the job runs; reports cover ``run_date - lag_days``
    and, on the first of a month, the calendar month before ``run_date``.
    Dates are pure calendar arithmetic, so no time zone or clock is involved.
    """

    run_date: date
    lag_days: int = 1

    @property
    def txn_day(self) -> date:
        return self.run_date - timedelta(days=self.lag_days)

    @property
    def txn_date(self) -> str:
        """Reported day as ``yyyy-MM-dd``, the value of ``dt`` and ``txn_date``."""
        return self.txn_day.isoformat()

    @property
    def month_end_excl(self) -> date:
        return self.run_date.replace(day=1)

    @property
    def month_start(self) -> date:
        return (self.month_end_excl - timedelta(days=1)).replace(day=1)

    @property
    def txn_month(self) -> str:
        """Reported month as ``yyyy-MM``."""
        return self.month_start.isoformat()[:7]

    @property
    def is_month_start(self) -> bool:
        return self.run_date.day == 1
