"""Run parameters for the account-health metric.

Everything the SQL models took as a variable (or hard-coded as a literal) is a
field here, so a run is fully described by one frozen object.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _sunday(d: dt.date) -> dt.date:
    """The Sunday on or after `d`."""
    return d + dt.timedelta(days=6 - d.weekday())


@dataclass(frozen=True)
class MetricConfig:
    # snapshot calendar: every month-end from the month of `snapshot_start`
    # through the month of `snapshot_end`
    snapshot_start: dt.date = _d("2000-01-31")
    snapshot_end: dt.date = _d("2001-06-30")

    # trailing windows (closed on both ends: 90 days = 91 dates)
    cv_window_days: int = 90
    red_lookback_days: int = 30
    # C component needs at least this many usage rows in the window
    min_usage_rows: int = 10

    # expansion flag: trailing usage >= threshold * 3 * allotment (>= in the
    # current formula, > in the single-date v1 formula)
    expansion_overage_threshold: float = 0.90
    expansion_strict: bool = False
    expansion_days_to_renewal: int = 180

    # bands
    band_green_cutoff: float = 75.0
    band_yellow_cutoff: float = 50.0

    # ramp (onboarding) period; None disables the rule (v1 formula)
    ramp_period_days: int | None = 90

    # component weights (fixed values of the metric definition)
    w_d: float = 0.20
    w_c: float = 0.30
    w_t: float = 0.25
    w_r: float = 0.15
    w_b: float = 0.10

    # T formula generation: "current" (colour + aged load + trend) or "v1"
    t_formula: str = "current"

    # date used by the single-date variant and the as-of reports
    scoring_date: dt.date = _d("2001-01-31")
    as_of: dt.date = _d("2001-06-30")

    # weekly health derivation: Sundays from `health_start` (None: from the first
    # contract on) to the end of the week of `as_of`
    health_start: dt.date | None = None

    @property
    def health_first(self) -> dt.date | None:
        """The Sunday that closes the week of `health_start`."""
        return self.health_start and _sunday(self.health_start)

    @property
    def health_end(self) -> dt.date:
        return _sunday(self.as_of)

    @classmethod
    def v1(cls, **kw) -> "MetricConfig":
        """The older single-date formula: T = .6 colour + .4 sev-1/2 load,
        strict 1.20x expansion threshold, no ramp rule."""
        base = cls(
            expansion_overage_threshold=1.20,
            expansion_strict=True,
            ramp_period_days=None,
            t_formula="v1",
        )
        return replace(base, **kw)

    def with_(self, **kw) -> "MetricConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class FilterSet:
    """Report filters; an empty tuple means "no filter" on that dimension."""

    snapshot_date: dt.date | None = None
    regions: tuple = field(default_factory=tuple)
    csm_ids: tuple = field(default_factory=tuple)
    segments: tuple = field(default_factory=tuple)
    account_ids: tuple = field(default_factory=tuple)
    # tenure toggles: include ramping / include established accounts
    include_ramp: bool = True
    include_established: bool = True


DEFAULT = MetricConfig()
