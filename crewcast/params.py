"""Settings shared by all operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Labels of the status codes that the allocation writes.
STATUS_LABELS: dict[int, str] = {
    0: "placed",
    2: "crew busy",
    3: "no qualified crew",
    4: "no free crew or slot",
    5: "bad data",
    6: "site locked",
    8: "unknown booked crew",
    9: "outside planning window",
}


@dataclass(frozen=True)
class Params:
    """One immutable settings object; paths are given to readers and writers directly."""

    # forecasting
    categorical_cols: tuple[str, ...] = ("region", "market", "package_name")
    numerical_cols: tuple[str, ...] = ("latitude", "longitude")
    use_numeric: bool = False
    model: str = "random_forest"
    folds: int = 10
    parallelism: int = 3
    seed: int = 123

    # planning calendar
    as_of: dt.date = dt.date(1998, 6, 1)
    country_code: str = ""
    calendar_start_year: int = 1990
    calendar_end_year: int = 2010
    weekmask: str = "1111100"

    # job defaults and limits, in days unless noted
    site_readiness_span: int = 30
    job_buffer: int = 1
    job_duration: int = 10
    job_duration_max: int = 60
    job_default_priority: int = 5
    scheduled_backlog_offset: int = 90
    job_start_buffer: int = 2
    job_downtime: int = 2
    site_distance_min: float | None = None  # km; None switches neighbour locks off
    placeholder_crew: str | None = None  # bookings to this name are not real
    tracking_codes: dict[int, str] = field(default_factory=lambda: dict(STATUS_LABELS))

    # helpers that only the capacity view uses
    workers_downtime: int = 2
    resource_shortage_msg: str = "Resource shortage"

    # size of one placement window; a round gives a task several small ones
    window_jobs: int = 20_000

    def __post_init__(self) -> None:
        if len(self.weekmask) != 7 or set(self.weekmask) - {"0", "1"} or "1" not in self.weekmask:
            raise ValueError("weekmask needs seven 0/1 digits, Monday first, with at least one 1")
        if self.calendar_start_year > self.calendar_end_year:
            raise ValueError("calendar_start_year is after calendar_end_year")
        if self.job_start_buffer < 0:
            raise ValueError("job_start_buffer is negative: a start in the past cannot be planned")
        if self.window_jobs < 1:
            raise ValueError("window_jobs must be positive")

    @property
    def calendar_first(self) -> dt.date:
        """First day that the calendar knows: the given years, or earlier if planning needs it."""
        return min(dt.date(self.calendar_start_year, 1, 1), dt.date(self.as_of.year - 1, 1, 1))

    @property
    def calendar_last(self) -> dt.date:
        """Last day that the calendar knows: the given years, or later if planning needs it.

        A job that starts on the last day of the plan ends well before: its business days
        count seven times each, which leaves room for weekly closures and holidays.
        """
        needed = self.plan_end + dt.timedelta(days=7 * (self.job_duration_max + self.job_buffer) + 366)
        return max(dt.date(self.calendar_end_year, 12, 31), dt.date(needed.year, 12, 31))

    @property
    def plan_end(self) -> dt.date:
        """Last day on which a job may start."""
        return self.as_of + dt.timedelta(days=self.scheduled_backlog_offset)
