"""Business settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from tallywright.functions import fixed_values as fixed


@dataclass(frozen=True)
class Config:
    analysis_start: date = fixed.ANALYSIS_START
    #: upper bound on source timestamps; ``None`` means the time of the query
    clamp_ts: datetime | None = None
    active_window_days: int = fixed.ACTIVE_WINDOW_DAYS
    lapsing_days: int = fixed.LAPSING_DAYS
    settling_days: int = fixed.COMPLETENESS_SETTLING_DAYS
    max_window_days: int = fixed.MAX_COMPLETENESS_WINDOW_DAYS
    volume_multiple: float = fixed.VOLUME_ANOMALY_MULTIPLE
    volume_floor: float = fixed.VOLUME_ANOMALY_FLOOR
    volume_baseline_days: int = fixed.VOLUME_BASELINE_DAYS
    volume_warm_up: float = fixed.VOLUME_WARM_UP
    revenue_statuses: tuple[str, ...] = fixed.REVENUE_STATUSES
    spine_end: date = fixed.SPINE_END
    #: "monday" or "sunday", for calendar weeks of the time spine
    week_start: str = "monday"
    #: "activity" ends a cohort's grid at its own last active month, "data" at
    #: the last active month of any cohort
    cohort_grid_end: str = "activity"
    freshness_warn_hours: int = fixed.FRESHNESS_WARN_HOURS
    freshness_error_hours: int = fixed.FRESHNESS_ERROR_HOURS
