"""One explicit run date for the whole job.

The monthly window is always the seven closed months before the run month:
``mes_6`` = run - 7 months ... ``mes_1`` = run - 2, ``mes_atual`` = run - 1.
Every month key is computed once on the driver and enters the plan as a
literal, so Catalyst folds it and the scan sees plain range bounds.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Number of closed months in the window (current month + six history months).
WINDOW_MONTHS = 7


def _shift_month(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from ``day``'s month."""
    index = day.year * 12 + (day.month - 1) + months
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class RunContext:
    """Run parameters: ``run_date`` fixes the window, ``run_ts`` stamps alarms.

    ``run_ts=None`` means "stamp with the session's local timestamp at run".
    """

    run_date: dt.date
    run_ts: dt.datetime | None = field(default=None)

    @classmethod
    def today(cls) -> "RunContext":
        now = dt.datetime.now()
        return cls(now.date(), now.replace(microsecond=0))

    def month_start(self, offset: int) -> dt.date:
        """First day of the month ``offset`` months before the run month."""
        return _shift_month(self.run_date, -offset)

    def month_key(self, offset: int) -> str:
        """``yyyyMM`` text of the month ``offset`` months before the run month."""
        return self.month_start(offset).strftime("%Y%m")

    @property
    def period(self) -> str:
        """Reference period shown on every alarm row: the last closed month."""
        return self.month_key(1)

    def window_bounds(self) -> tuple[dt.date, dt.date]:
        """Half-open ``[start, end)`` date range covering the seven closed months."""
        return self.month_start(WINDOW_MONTHS), self.month_start(0)

    def month_columns(self) -> list[tuple[str, str]]:
        """(column name, month key) for the pivot, oldest first."""
        names = [f"mes_{k}" for k in range(WINDOW_MONTHS - 1, 0, -1)] + ["mes_atual"]
        offsets = range(WINDOW_MONTHS, 0, -1)
        return [(name, self.month_key(off)) for name, off in zip(names, offsets)]


# Fixed run of the test fixtures (FIXTURES.md): window 200101..200107.
FIXTURE_RUN = RunContext(dt.date(2001, 8, 15), dt.datetime(2001, 8, 15, 0, 0, 0))
