"""Business thresholds, in one place."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# The parks captured by default, and the provenance labels stamped on every row.
TARGET_PARKS = (
    "Magic Kingdom",
    "Epcot",
    "Disney's Hollywood Studios",
    "Disney's Animal Kingdom",
)
LIVE_SOURCE = "queue-times-api"
SEED_SOURCE = "synthetic"


@dataclass(frozen=True)
class Params:
    # Business hours, half-open: a snapshot counts when open_hour <= hour < close_hour.
    open_hour: int = 9
    close_hour: int = 22
    # One closed snapshot stands for this many minutes of downtime.
    snapshot_interval_minutes: int = 15
    # Outages shorter than this are dropped.
    min_downtime_minutes: int = 15

    # Report settings.
    top_rides: int = 12
    rolling_rows: int = 7
    lookback_days: int = 29


@dataclass(frozen=True)
class Scope:
    """What a report looks at: some parks, or None for all of them, and an inclusive range of dates."""

    parks: tuple[str, ...] | None
    start: dt.date
    end: dt.date

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def prior_start(self) -> dt.date:
        """First date of the period of equal length that ends the day before `start`."""
        return self.start - dt.timedelta(days=self.days)
